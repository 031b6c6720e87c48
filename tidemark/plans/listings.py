"""Listings over many pages (H2, W1): pages land, their links are followed, the first hits count.

Orders stand in for articles.  Each order status is a listing whose pages are runs of order
keys, some of them empty; its length grows with the table.  Each remainder of the customer
key is a short one of 1 to ``SHORT`` pages.  Some listings run into themselves: the last page
leads back to the first, or to one in the middle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pages
from ..operators.dedupe import top_n
from ..session import scratch_path, staged
from ..sources.tables import read_table, spread
from . import catalog as C

#: Order keys of a page of a long listing, pages of the longest short one, hits of a listing.
RUN, SHORT, HITS = 80, 97, 100
_BASE = "https://board.example"


def landed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, html): the listing pages, written once."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    short = (F.col("o_custkey") % SHORT).cast("long")
    entry = F.col("o_orderkey").cast("long").alias("k")
    rows = o.select(F.concat(F.lit("s"), F.col("o_orderstatus")).alias("chain"), F.expr(f"o_orderkey div {RUN}").alias("at"), entry).unionByName(
        o.select(F.concat(F.lit("u"), short).alias("chain"), (F.col("o_orderkey") % (short + 1)).cast("long").alias("at"), entry))

    def div(k: F.Column) -> F.Column:
        text = F.when(k % 11 == 0, F.lit('<div class="title">gone</div>')).otherwise(F.concat(
            F.lit('<div class="title"><a href="/o/'), k, F.lit('"> No '), k, F.lit(" </a></div>")))
        return F.concat(F.lit('<div class="r-ent">'), text, F.lit('<div class="date">'), k % 12 + 1, F.lit("/"), k % 28 + 1, F.lit("</div></div>"))

    # A page's entries are gathered as keys and become markup where the page is written.
    listed = rows.groupBy("chain", "at").agg(F.sort_array(F.collect_list("k")).alias("e"))
    # All pages of a listing, also those without entries.
    chains = rows.groupBy("chain").agg(F.max("at").alias("at")).select("chain", F.when(
        F.col("chain").startswith("u"), F.expr("cast(substr(chain, 2) as long)")).otherwise(F.col("at")).alias("last"))
    every = chains.select("chain", "last", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("at"))
    back = F.when(F.col("chain") == "sP", 0).when(F.col("chain").startswith("u") & (F.col("last") % 7 == 3), F.expr("last div 2"))
    following = F.when(F.col("at") < F.col("last"), F.col("at") + 1).otherwise(back)
    link = lambda to: F.concat(F.lit('<a class="btn wide" href="/'), F.col("chain"), F.lit("/"), to, F.lit('">‹ 上頁</a>'))
    html = F.concat(F.lit('<div class="bar"><a class="btn wide" href="/first">最舊</a>'), F.coalesce(link(following), F.lit('<a class="btn wide">‹ 上頁</a>')),
                    F.lit("</div>"), F.coalesce(F.array_join(F.transform("e", div), ""), F.lit("")))
    made = every.join(listed, ["chain", "at"], "left").select(F.concat_ws("/", F.lit(_BASE), "chain", "at").alias("url"), html.alias("html"))
    path = scratch_path(spark, "listings")
    # Pages differ by a thousand times in size: a writer and a reader hold a row group, so those are small and looked at page by page.
    made.write.option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 100).parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@C.register("listing_hits", f"""
WITH RECURSIVE r AS (
  SELECT 's' || o_orderstatus AS chain, o_orderkey // {RUN} AS nr, o_orderkey AS k FROM orders
  UNION ALL SELECT 'u' || (o_custkey % {SHORT}), o_orderkey % (o_custkey % {SHORT} + 1), o_orderkey FROM orders),
c AS (SELECT chain, CASE WHEN chain LIKE 'u%' THEN CAST(substr(chain, 2) AS BIGINT) ELSE max(nr) END AS last FROM r GROUP BY chain),
w AS (SELECT chain, last, CAST(0 AS BIGINT) AS nr, 0 AS rank FROM c
      UNION ALL
      SELECT chain, last, CASE WHEN nr < last THEN nr + 1 WHEN chain = 'sP' THEN 0 ELSE last // 2 END, rank + 1 FROM w
      WHERE rank <= last AND (nr < last OR chain = 'sP' OR (chain LIKE 'u%' AND last % 7 = 3))),
p AS (SELECT chain, nr, min(rank) AS rank FROM w GROUP BY chain, nr),
h AS (SELECT r.chain, k, row_number() OVER (PARTITION BY r.chain ORDER BY p.rank, k) AS hit
      FROM r JOIN p ON p.chain = r.chain AND p.nr = r.nr WHERE k % 11 <> 0)
SELECT '{_BASE}/' || chain AS listing, CAST(hit AS INTEGER) AS hit, 'No ' || k AS title, '{_BASE}/o/' || k AS url,
       (k % 12 + 1) || '/' || (k % 28 + 1) AS date
FROM h WHERE hit <= {HITS}""")
def listing_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hits of every listing, in the order in which its pages are read."""
    landed = landed_listings(spark, sf_dir)
    links = staged(pages.extract_next(spread(landed), "html", "url", base=_BASE), "listing-links")
    first = links.where(F.col("url").endswith("/0")).select(F.regexp_replace("url", "/0$", "").alias("start"), "url")
    order = pages.listing_order(links, first, "url", "next_url")
    found = pages.extract_links(spread(landed.select(F.col("url").alias("page"), "html")), "html", "page", base=_BASE)
    entries = found.select("page", "pos", "title", F.col("url").alias("link"), "date")
    hits = top_n(order.join(entries, order["url"] == entries["page"]).select("start", "rank", "pos", "title", "link", "date"),
                 ["start"], [F.col("rank"), F.col("pos")], HITS, "hit")
    return hits.select(F.col("start").alias("listing"), "hit", "title", F.col("link").alias("url"), "date")
