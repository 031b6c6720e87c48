"""Secret scan: broad candidates, then a random forest that removes false positives.

Candidates are private key blocks, all values assigned to a name that ends in one of
``NAMES``, quoted or up to white space, and other tokens of 12 or more characters of
``[A-Za-z0-9+/_~-]``, with padding, that hold a digit or begin like a published key format; of
``name=value`` the value is the token.  The forest sees a candidate's length,
its shares of character classes and transitions between them, how many different
characters it has, how much of it is dictionary words, the document's path and the words
around it, and is trained on labelled findings.  Built-in expressions and Spark ML only.

Where no labelled findings are given, ``weakly_labelled`` makes them from two views.  By its
form a value in a published key format, a private key, or a mixed value assigned to a
secret's name, can be a secret.  By its use it is a placeholder if it stands in over
``PLACES`` different contexts of the corpus, which no feature shows; so the forest learns from
repeated placeholders what they look like, and rejects others of that look that the form
accepts.  The fit takes at most ``SAMPLE`` different findings of each class; copies count once.

Spans are in code points, end exclusive.

Edge cases: null and empty texts have no candidates; copies and repeated rows have equal
findings, each their own; a null path or doc_id is allowed; without findings of both
classes no forest is fitted and the weak label decides; very long tokens are one candidate
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, bounded_sample, fresh, join_sized, let, staged, text_of

#: Names that secrets are assigned to.
NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "api-key", "apikey", "access_key", "access-key",
         "secret_key", "secret-key", "private_key", "auth_token", "client_secret", "credentials")
#: Published formats of keys.
FORMATS = (r"AKIA[0-9A-Z]{16}", r"ASIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"github_pat_[A-Za-z0-9_]{22,}",
           r"xox[baprs]-[A-Za-z0-9-]{10,}", r"sk_live_[A-Za-z0-9]{24,}", r"AIza[0-9A-Za-z_-]{35}", r"glpat-[A-Za-z0-9_-]{20}",
           r"npm_[A-Za-z0-9]{36}", r"eyJ[A-Za-z0-9_-]{10,}")
#: Common words that show that a token is text or a name.
DICTIONARY = ("the", "and", "that", "with", "this", "from", "have", "not", "you", "for", "are", "was", "http", "https", "www", "com", "org",
              "net", "html", "page", "image", "file", "name", "user", "admin", "test", "example", "sample", "dummy", "demo", "data", "date",
              "time", "value", "number", "version", "index", "list", "item", "table", "node", "path", "home", "main", "part", "page", "link",
              "section", "chapter", "figure", "module", "class", "function", "string", "object", "default", "config", "system", "server",
              "client", "model", "type", "order", "line", "text", "title", "content", "message", "changeme", "placeholder", "your", "here")

_CHARS, _NAME = "[A-Za-z0-9+/_~-]", "[A-Za-z0-9_.-]"
_SET = r"[\"']?\]?[ \t]{0,3}"
#: A name that ends in a listed one, looked for only where a name is followed by an assignment.
_ASSIGNED = rf"(?={_NAME}++{_SET}[:=]){_NAME}*?(?i:" + "|".join(NAMES) + rf"){_SET}(?:=>|:=|={{1,3}}|:)[ \t]{{0,3}}"
#: What is quoted, else all up to white space, a quote or the next parameter, without closing marks.
_QUOTED = "|".join(rf"{q}(?!{q})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+(?={q})" for q in "\"'")
#: A run of closing marks is read once, from where it begins, so that long ones stay linear.
_BARE = rf"[\"']?[^\s\"']+?(?=(?:(?<![,;)\]}}])[,;)\]}}]*+)?+(?:[\s\"']|\z)|[&;]{_NAME}++=)"
_BLOCK = "[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
#: A block up to its end, or as far as its lines go.
_PRIVATE = rf"-----BEGIN {_BLOCK}(?:[^-]*+(?:-{{1,4}}+(?!-)[^-]*+)*+-----END {_BLOCK}|(?:\s*+[A-Za-z0-9+/=]{{16,}}+)++)"
#: Other candidates hold a digit or begin like a published format (random keys may lack digits).
_STARTS = "AKIA|ASIA|gh[pousr]_|github_pat_|xox[baprs]-|sk_live_|AIza|glpat-|npm_|eyJ"
_PADDED = rf"(?:{_CHARS}{{12,}}+(?:={{1,2}}+(?!{_CHARS}))?+|{_CHARS}{{11}}=(?!{_CHARS}|=)|{_CHARS}{{10}}==(?!{_CHARS}))"
CANDIDATE = (rf"{_PRIVATE}|(?<!{_NAME}){_ASSIGNED}(?:{_QUOTED}|{_BARE})"
             rf"|(?<!{_CHARS})(?=[A-Za-z+/_~-]*+[0-9]|{_STARTS}){_PADDED}")
_HEAD = rf"^({_ASSIGNED}[\"']?)(?=.)"

#: Different findings of each class that the fit takes at most.
SAMPLE = 5_000
TREES, DEPTH, SEED = 20, 6, 7
#: Findings of a leaf at least, fewer where a class has under LEAF squared; single findings are not learned by heart.
LEAF = 8
#: Different contexts in which a secret stands at most, for the weak labels.
PLACES = 5
SECRET = 0.5
#: Characters around a candidate that are looked at.
_NEAR = 60
FEATURES = ("length", "digits", "upper", "lower", "other", "transitions", "distinct", "hex", "dictionary", "assigned", "quoted",
            "path_depth", "path_test", "path_bucket", "before_bucket", "after_bucket", "before_length", "after_length")


def _value(found: Column) -> Column:
    return F.regexp_replace(found, _HEAD, "")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, start, end, assigned, value, before, after), one row per candidate.

    ``path`` is the document's ``path`` column, else its ``source``, else empty.
    """
    at = next((c for c in ("path", "source") if c in docs.columns), None)
    path = F.coalesce(F.col(at).cast("string"), F.lit("")) if at else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), text_of().alias("text"))
    rows = rows.withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).filter(F.size("found") > 0)
    rows = rows.withColumn("gaps", F.split("text", CANDIDATE, -1)).select("doc_id", "path", "found", "gaps")

    def place(found: Column, gaps: Column) -> Column:
        """Where each candidate begins: the gaps and candidates before it."""
        return F.aggregate(F.arrays_zip(found.alias("f"), F.slice(gaps, 1, F.size(found)).alias("g")),
                           F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
                           lambda s, x: F.struct((s["at"] + F.length(x["g"]) + F.length(x["f"])).alias("at"),
                                                 F.array_append(s["starts"], s["at"] + F.length(x["g"])).alias("starts")),
                           lambda s: s["starts"])

    rows = rows.withColumn("starts", place(F.col("found"), F.col("gaps")))
    one = rows.select("doc_id", "path", F.posexplode(F.transform("found", lambda f, i: F.struct(
        f.alias("found"), F.get("starts", i).alias("at"), F.right(F.get("gaps", i), F.lit(_NEAR)).alias("left"),
        F.left(F.get("gaps", i + 1), F.lit(_NEAR)).alias("right")))).alias("i", "c")).select("doc_id", "path", "c.*")
    value = _value(F.col("found"))
    return (one.withColumn("value", value)
            .withColumn("assigned", F.length("value") < F.length("found"))
            .select("doc_id", "path", (F.col("at") + F.length("found") - F.length("value")).alias("start"),
                    (F.col("at") + F.length("found")).alias("end"), "assigned", "value",
                    F.col("left").alias("before"), F.col("right").alias("after")))


def _share(value: Column, drop: str) -> Column:
    return (F.length(value) - F.length(F.regexp_replace(value, drop, ""))) / F.length(value)


def with_features(found: DataFrame) -> DataFrame:
    """``found`` with the columns of FEATURES."""
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]", "9"), "[a-z]", "a"), "[A-Z]", "A"), "[^9aA]", "-")
    word = lambda side, k: F.element_at(F.split(F.btrim(side), SPACE_CLASS + "+"), k)
    bucket = lambda c: F.pmod(F.xxhash64(F.lower(c)), F.lit(16)).cast("double")
    left, right = word(before, -1), word(after, 1)
    made = {
        "length": F.length(v), "digits": _share(v, "[0-9]"), "upper": _share(v, "[A-Z]"), "lower": _share(v, "[a-z]"),
        "other": _share(v, "[^A-Za-z0-9]"), "transitions": (F.length(F.regexp_replace(classes, r"(.)\1*+", "$1")) - 1) / F.length(v),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(F.length(v), F.lit(64)), "hex": _share(v, "[0-9a-f]"),
        "dictionary": _share(F.lower(v), "|".join(sorted(set(DICTIONARY), key=lambda w: (-len(w), w)))),
        "assigned": F.col("assigned").cast("double"), "quoted": after.rlike("^[\"']").cast("double"),
        "path_depth": F.size(F.split("path", "/")), "path_test": F.col("path").rlike("(?i)test|example|sample|doc").cast("double"),
        "path_bucket": bucket(F.col("path")), "before_bucket": bucket(left), "after_bucket": bucket(right),
        "before_length": F.length(left), "after_length": F.length(right),
    }
    return found.select("*", *[F.coalesce(made[k].cast("double"), F.lit(0.0)).alias(f"f_{k}") for k in FEATURES])


def weak_labels(found: DataFrame) -> Column:
    """1 for a value of a published format, a private key, or a mixed value assigned to a secret's name, else 0."""
    v = F.col("value")
    return (v.rlike("^(?:" + "|".join(FORMATS) + ")$") | v.startswith("-----BEGIN ") | (F.col("assigned") & v.rlike("[A-Za-z]") & v.rlike("[0-9]"))).cast("int")


def weakly_labelled(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: the form of a secret, in few different contexts (spaces and case aside)."""
    plain = lambda c: F.regexp_replace(F.lower(c), SPACE_CLASS + "+", " ")
    rows = staged(found.withColumn("form", weak_labels(found)).withColumn("vh", F.xxhash64("value")), "weak-findings")
    places = rows.filter("form = 1").groupBy("vh", F.xxhash64(plain("before"), plain("after")).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    places = staged(places.groupBy("vh").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places")).filter(f"places > {PLACES}"), "placeholders")
    # Rows of values in many contexts meet them by sizes, since one may stand in a third of all rows.
    return join_sized(rows, places, "vh", "n").withColumn("label", F.when(F.col("places").isNull(), F.col("form")).otherwise(0)).select(*found.columns, "label")


def fit(labelled: DataFrame, sample: int = SAMPLE):
    """A forest for (candidate columns, label), or None unless both classes occur."""
    key = ("value", "before", "after")
    rows = labelled.groupBy(*key, "label").agg(F.min(F.struct("path", "assigned")).alias("one")).select(*key, "label", "one.*")
    rows = staged(rows, "different-findings")
    part = bounded_sample(rows.filter("label = 1"), sample, *key).unionByName(bounded_sample(rows.filter("label = 0"), sample, *key))
    part = staged(with_features(part), "findings")
    sizes = [r["count"] for r in part.groupBy("label").count().collect()]  # two classes
    if len(sizes) < 2:
        return None
    leaf = max(1, min(LEAF, min(sizes) // LEAF))
    x = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(part.withColumn("label", F.col("label").cast("double")))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=leaf, seed=SEED).fit(x)


def judge(found: DataFrame, model) -> DataFrame:
    """``found`` with ``score`` and ``is_secret``."""
    if model is None:
        return found.withColumn("score", weak_labels(found).cast("double")).withColumn("is_secret", F.col("score") >= SECRET)
    x = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(with_features(found))
    return (model.transform(x).withColumn("score", vector_to_array("probability")[1])
            .withColumn("is_secret", F.col("score") >= SECRET).select(*found.columns, "score", "is_secret"))


def _model(found: DataFrame, labelled: DataFrame | None):
    return fit(weakly_labelled(found) if labelled is None else labelled)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, end, assigned, value_sha256, score, is_secret), one row per candidate."""
    found = staged(candidates(docs), "candidates")
    return judge(found, _model(found, labelled)).select(
        "doc_id", "start", "end", "assigned", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        F.round("score", 6).alias("score"), "is_secret")


def redact(docs: DataFrame, labelled: DataFrame | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret's characters replaced by ``mark``; ``n_chars`` follows the text if there is one.

    Documents without candidates pass through; for the others the secrets' spans are found
    by a hash of text and path, so equal texts get equal cuts and need one lookup.
    """
    at = next((c for c in ("path", "source") if c in docs.columns), None)
    path = F.coalesce(F.col(at).cast("string"), F.lit("")) if at else F.lit("")
    key = F.xxhash64(text_of(), path)
    by, spans, made = (fresh(c, docs) for c in ("key", "cuts", "new"))
    rows = docs.select(key.alias("doc_id"), "text", *([at] if at else []))
    found = staged(candidates(rows), "candidates")
    cuts = (judge(found, _model(found, labelled)).filter("is_secret").select("doc_id", "start", "end").distinct()
            .groupBy(F.col("doc_id").alias(by)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spans)))  # one text's spans
    cuts = staged(cuts, "cuts")  # of known size, so that texts are not shuffled to meet a few spans
    text = text_of()

    def rebuilt(cuts: Column) -> Column:
        done = F.aggregate(cuts, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda s, c: F.struct(
            F.concat(s["out"], F.substr(text, s["at"] + 1, c["start"] - s["at"]), F.lit(mark)).alias("out"), c["end"].alias("at")))
        return let(done, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1)))

    new = F.when(F.col(spans).isNull(), F.col("text")).otherwise(rebuilt(F.col(spans)))
    # In a step of its own: beside a column named text, the lambdas would read that one.
    joined = docs.withColumn(by, key).join(cuts, by, "left").withColumn(made, new)
    out = {c: F.col(c) for c in docs.columns} | {"text": F.col(made)}
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(made).cast(kind))
    return joined.select(*[c.alias(k) for k, c in out.items()])
