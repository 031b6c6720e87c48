"""Chain pages end to end (H3-H5): pages rendered from the tables, rows extracted from them.

The landed pages hold no chain markup, so every part is rendered as one index page and one
chain page of bounded size, with the irregular cases that the rules name: mentions in
links and in ``onclick`` texts, a mention outside any item, a hidden block, a link without
a code, a cell without bold text, a segment without a title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedupe, pages
from ..sources.tables import dealt, read_table
from . import catalog as C


def _ic(prefix: str, value: str) -> F.Column:
    return F.concat(F.lit(prefix), F.col(value).cast("string"))


@C.register("chain_index", """
WITH m AS (
  SELECT p_partkey, 0 AS pos, replace(p_brand, 'Brand#', 'B') AS chain_ic, p_type AS major_industry FROM part
  UNION ALL SELECT p_partkey, 1, 'P' || p_partkey, '' FROM part
  UNION ALL SELECT p_partkey, 2, 'S' || p_size, p_type FROM part)
SELECT chain_ic, major_industry FROM (
  SELECT *, row_number() OVER (PARTITION BY chain_ic ORDER BY p_partkey DESC, pos DESC) AS rn FROM m) WHERE rn = 1""")
def chain_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain id -> category from index pages, later mentions replace earlier."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size")
    p = dealt(p, p.count())
    brand = F.replace("p_brand", F.lit("Brand#"), F.lit("B"))
    html = F.concat(
        F.lit('<body><div class="box item"><a class="link" href="#"><b>&raquo;</b><span class="txt"> '), F.col("p_type"),
        F.lit(' </span></a><ul><li><a href="introduce.php?ic='), brand, F.lit('">'), F.col("p_brand"),
        F.lit("</a><li><span class=\"itemLink\" onclick=\"location.href='introduce.php?ic="), _ic("S", "p_size"),
        F.lit("'\">size</span></ul></div><a href=\"/x/introduce.php?ic="), _ic("P", "p_partkey"),
        F.lit('&amp;y=1">single</a><a href="introduce.php?ic=">none</a></body>'))
    found = pages.extract_chain_index(p.select("p_partkey", html.alias("html")), "html", "p_partkey")
    return dedupe.last_wins(found, ["chain_ic"], ["p_partkey", "pos"]).select("chain_ic", "major_industry")


@C.register("chain_pages", """
WITH p AS (SELECT replace(p_brand, 'Brand#', 'B') AS chain_ic, * FROM part LEFT JOIN supplier ON s_suppkey = p_size)
SELECT chain_ic, p_type AS segment_code, p_type AS segment_name, 'Listed ' || p_size AS listing_bucket,
       CAST(s_suppkey AS VARCHAR) AS stock_code, s_name AS stock_name, p_brand AS chain_topic FROM p WHERE s_suppkey IS NOT NULL
UNION ALL SELECT chain_ic, p_type, p_type, '', CAST(p_partkey AS VARCHAR), p_name, p_brand FROM p
UNION ALL SELECT chain_ic, lower(p_type), '', '', CAST(p_partkey AS VARCHAR), p_brand, p_brand FROM p""")
def chain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock rows of chain pages with segment, bucket and chain topic."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    j = dealt(p.join(s, p["p_size"] == s["s_suppkey"], "left"), p.count())
    link = lambda code, more, text: F.concat(F.lit('<a href="company_basic.php?stk_code='), code.cast("string"),
                                             F.lit('"'), more, F.lit(">"), text, F.lit("</a>"))
    seller = F.coalesce(link(F.col("s_suppkey"), F.concat(F.lit(' title=" '), F.col("s_name"), F.lit('"')), F.lit("x")), F.lit(""))
    own, none = F.col("p_partkey"), F.lit("")
    html = F.concat(
        F.lit("<h3> "), F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, F.lit(C._SUFFIX)).otherwise(F.lit("")),
        F.lit('</h3><noscript><div id="companyList_Z9">'), link(own, none, F.lit("hidden")),
        F.lit('</div></noscript><div id="companyList_'), F.col("p_type"), F.lit('" title=" '), F.col("p_type"),
        F.lit(' "><table><tr><td><b> Listed '), F.col("p_size").cast("string"), F.lit("</b></td><td>"), seller,
        link(F.lit("none"), none, F.lit("no code")), F.lit("</td></tr><tr><td>plain</td><td>"), link(own, none, F.col("p_name")),
        F.lit('</td></tr></table></div><div id="companyList_'), F.lower("p_type"), F.lit('">'), link(own, none, F.col("p_brand")), F.lit("</div>"))
    return pages.extract_chain_rows(j.select(F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("chain_ic"), html.alias("html")))
