"""URL filter: fixed rules first, else the host's reputation, in built-in expressions only.

Reputation is an empirical Bayes estimate of the share of bad pages.  Labelled page
outcomes are counted per host; the beta prior of a host is centred on its registered
domain's posterior mean, the domain's on its suffix's, the suffix's on the overall mean,
and the weight of each prior is fitted to the spread of the units below it (moments of the
beta-binomial).  A host is blocked if the lower bound of its posterior is above the limit.

The suffix is the last label of a host, or the last two where those are one of ``SUFFIXES``, and
the registered domain has one label more; a port belongs to neither.

Edge cases: a null url and one without ``://`` have an empty host and path, fit no rule and
are judged as the empty host; repeated rows are judged row by row; a null page_id is kept;
without labelled pages the overall mean is one half with almost no weight, and nothing is
blocked; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Fixed values of the contract: (verdict, rule).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

#: Public suffixes of two labels.
SUFFIXES = ("ac.jp", "ac.uk", "co.id", "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br",
            "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.pe", "com.ph", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn",
            "edu.au", "edu.cn", "edu.tw", "gov.au", "gov.br", "gov.cn", "gov.tw", "gov.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.tw",
            "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.tw", "org.uk")

#: A host is blocked if its share of bad pages is over this with the confidence of Z.
MAX_BAD = 0.5
Z = 1.645
#: Least and greatest weight of a prior, in pages.
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _fits(rule: str, host: Column, path: Column) -> Column:
    of, _, at = rule.partition("/")
    return ((host == of) | host.endswith("." + of)) & path.startswith("/" + at)


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does."""
    rule, verdict = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for what, text in sorted(rules, key=lambda x: -len(x[1])):
        rule, verdict = rule.when(_fits(text, host, path), text), verdict.when(_fits(text, host, path), what)
    return rule, verdict


def _weight(units: DataFrame) -> tuple[float, float]:
    """(overall mean, prior weight) for units (n, bad) by the moments of the beta-binomial."""
    seen = units.filter("n > 0")
    t = seen.agg(F.sum("n").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"),
                 F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("units"),
                 F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("bb")).first()
    n, bad, units_ = t["n"] or 0.0, t["bad"] or 0.0, t["units"]
    mean = (bad + 1) / (n + 2)
    p = bad / n if n else 0.5
    between = (t["bb"] or 0.0) - n * p * p - (units_ - 1) * p * (1 - p)
    room = (n - (t["nn"] or 0.0) / n - (units_ - 1)) if n else 0.0
    share = between / (p * (1 - p) * room) if room > 0 and 0 < p < 1 else 0.0
    return mean, min(MAX_WEIGHT, max(MIN_WEIGHT, 1 / share - 1 if share > 0 else MAX_WEIGHT))


def _reversed(name: str) -> str:
    return ".".join(reversed(name.split(".")))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """(host, bound): lower bound of the bad share of each host of (host, n, bad)."""
    label = F.reverse(F.split(F.regexp_replace("host", ":[0-9]*$", ""), r"\."))
    last = lambda n: F.array_join(F.slice(label, 1, n), ".")
    long = last(2).isin(*[_reversed(x) for x in SUFFIXES])
    hosts = staged(hosts.select("host", "n", "bad", F.when(long, last(3)).otherwise(last(2)).alias("domain"),
                                F.when(long, last(2)).otherwise(last(1)).alias("suffix")), "hosts")
    domains = staged(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = staged(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    (mean, k0), (_, k1), (_, k2) = _weight(suffixes), _weight(domains), _weight(hosts)
    centre = lambda prior, k: (F.col("bad") + k * prior) / (F.col("n") + k)
    suffixes = suffixes.select("suffix", centre(F.lit(mean), k0).alias("s"))
    domains = domains.join(suffixes, "suffix").select("suffix", "domain", centre(F.col("s"), k1).alias("d"))
    m = centre(F.col("d"), k2)
    return hosts.join(domains, ["suffix", "domain"]).select("host", (m - Z * F.sqrt(m * (1 - m) / (F.col("n") + k2 + 1))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_bound), one row per row of ``pages``.

    ``outcomes``: (url, bad 0 or 1) of labelled pages.  ``rules``: a short list; it becomes
    one CASE expression.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    seen = outcomes.select(host_and_path(F.col("url").cast("string"))[0].alias("host"), F.col("bad").cast("long").alias("bad"))
    # Map-side sums: a host with a third of all pages is one row per task.
    counts = (page.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
              .unionByName(seen.filter("bad IS NOT NULL").select("host", F.lit(1).cast("long").alias("n"), "bad"))
              .groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("bound") > MAX_BAD, "block").otherwise("allow")
    return (page.join(host_reputation(counts), "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                    F.round("bound", 4).alias("bad_bound")))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of pages whose address ends in the number of a labelled document.

    A page is bad if a label of its document says low quality or toxic.
    """
    number = F.expr("try_cast(nullif(regexp_extract(url, '^[^?#]*/([0-9]+)', 1), '') AS bigint)")
    bad = (labels.select(F.col("doc_id").cast("long").alias("doc"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
           .groupBy("doc").agg(F.max("bad").alias("bad")))
    return pages.select(F.col("url").cast("string").alias("url"), number.alias("doc")).join(bad, "doc").select("url", "bad")


def _oracle() -> str:
    case = lambda pick: " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{pick(w, r)}'"
        for w, r in sorted(RULES, key=lambda x: -len(x[1])) for h, _, p in [r.partition("/")])
    level = lambda name, src: f"""
{name}_w AS (SELECT *, CASE WHEN sh > 0 THEN greatest({MIN_WEIGHT}, least({MAX_WEIGHT}, 1 / sh - 1)) ELSE {MAX_WEIGHT} END AS k FROM (
  SELECT (b + 1) / (n + 2) AS mean, CASE WHEN b > 0 AND b < n AND n - nn / n - (u - 1) > 0
    THEN (bb - n * (b / n) * (b / n) - (u - 1) * (b / n) * (1 - b / n)) / ((b / n) * (1 - b / n) * (n - nn / n - (u - 1))) ELSE 0 END AS sh
  FROM (SELECT coalesce(sum(CAST(n AS DOUBLE)), 0) AS n, coalesce(sum(CAST(bad AS DOUBLE)), 0) AS b, coalesce(sum(CAST(n AS DOUBLE) * n), 0) AS nn,
          count(*) AS u, coalesce(sum(CAST(bad AS DOUBLE) * bad / n), 0) AS bb FROM {src} WHERE n > 0)))"""  # noqa: E731
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    host = f"translate(regexp_extract(coalesce({rest}, ''), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
    path = f"regexp_extract(coalesce({rest}, ''), '^[^/?#]*([^?#]*)', 1)"
    last = lambda n: f"array_to_string(list_reverse(string_split(regexp_replace(host, ':[0-9]*$', ''), '.'))[1:{n}], '.')"
    long = f"{last(2)} IN ({', '.join(repr(_reversed(x)) for x in SUFFIXES)})"
    return f"""
WITH p AS (SELECT page_id, {host} AS host, {path} AS path,
             TRY_CAST(nullif(regexp_extract(url, '^[^?#]*/([0-9]+)', 1), '') AS BIGINT) AS doc FROM pages),
lab AS (SELECT doc_id AS doc, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
h AS (SELECT host, CASE WHEN {long} THEN {last(2)} ELSE {last(1)} END AS suffix, CASE WHEN {long} THEN {last(3)} ELSE {last(2)} END AS domain,
        count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM p LEFT JOIN lab USING (doc) GROUP BY 1),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY 1),{level('s', 's')},{level('d', 'd')},{level('h', 'h')},
s2 AS (SELECT suffix, (bad + k * mean) / (n + k) AS m FROM s, s_w),
d2 AS (SELECT suffix, domain, (bad + k * m) / (n + k) AS m FROM d JOIN s2 USING (suffix), (SELECT k FROM d_w)),
h2 AS (SELECT host, m - {Z} * sqrt(m * (1 - m) / (n + k + 1)) AS bound
       FROM (SELECT host, h.n, k, (bad + k * m) / (h.n + k) AS m FROM h JOIN d2 USING (suffix, domain), (SELECT k FROM h_w)))
SELECT page_id, host, path, CASE {case(lambda w, r: r)} END AS rule,
  coalesce(CASE {case(lambda w, r: w)} END, CASE WHEN bound > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  round(bound, 4) AS bad_bound
FROM p JOIN h2 USING (host)
"""


ORACLE_SQL = _oracle()
