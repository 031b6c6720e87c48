"""Corpus profile, per-industry counts, topic x industry matrix, topic briefs, topic tree.

Every operator here reduces documents to topic- or industry-sized results with hash
aggregates first (partial aggregation map-side); anything that needs a global order
or a small lookup runs only on those reduced results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import (FALLBACK_COLOR, FINE_PREFIX, INDUSTRY_PALETTE, INDUSTRY_PREFIX,
                               MEDIUM_PREFIX, N_SAMPLES, N_TOP_INDUSTRIES, ROOT_COLOR, ROOT_ID,
                               ROOT_LABEL, SAMPLE_CHARS)
from ..functions.text import sample_text
from ..session import cut_lineage
from .dedupe import top_n

MAX_PIVOT_VALUES = 10_000


def corpus_profile(df: DataFrame, stock: str, industry: str) -> DataFrame:
    """A1/O3: rows, distinct stocks, distinct industries, sorted industry list (one aggregate;
    the industry set is bounded by the industry dimension)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(stock).alias("n_stocks"),
                  F.countDistinct(industry).alias("n_industries"),
                  F.array_sort(F.collect_set(F.col(industry))).alias("industries"))


def industry_counts(df: DataFrame, industry: str) -> DataFrame:
    """A2: rows per industry, descending."""
    return (df.groupBy(industry).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.col(industry)))


def pivot_values(df: DataFrame, col: str, max_values: int = MAX_PIVOT_VALUES) -> list:
    """Distinct non-null values of a pivot column, in code-point order (one small job)."""
    vals = (df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).limit(max_values + 1).collect())
    if len(vals) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values; not a pivot")
    return [r[0] for r in vals]


def topic_matrix(df: DataFrame, topic: str | Sequence[str], industry: str,
                 values: Sequence[str] | None = None, total: str = "total") -> DataFrame:
    """A3/O2: counts per (topic, industry) as one column per industry, plus a row total.

    Null topics are excluded; absent pairs are 0; rows by total descending, then topic.
    Pass ``values`` (from the industry dimension) so Spark plans the pivot in one
    aggregation without a job to discover them.
    """
    keys = [topic] if isinstance(topic, str) else list(topic)
    if values is None:
        values = pivot_values(df, industry)
    base = df.where(F.col(keys[-1]).isNotNull())
    m = base.groupBy(*keys).pivot(industry, list(values)).count().na.fill(0, subset=list(values))
    tot = sum((F.col(f"`{v}`") for v in values), F.lit(0).cast("bigint"))
    return m.withColumn(total, tot).orderBy(F.desc(total), *[F.col(k) for k in keys])


def topic_brief(df: DataFrame, topic: str | Sequence[str], industry: str, text: str, doc: str,
                keywords: DataFrame | None = None, n_samples: int = N_SAMPLES, n_industries: int = N_TOP_INDUSTRIES,
                sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Per non-empty topic its size, top industries, keywords and samples.

    ``keywords``: (topic keys..., rank, term) as ``topic_keywords`` gives them.

    top_industries: up to ``n_industries`` "name(n)" strings by count desc, name.
    samples: the ``n_samples`` shortest texts (ties by ``doc``), first ``sample_chars``
    code points with newlines as spaces.  Both are collected from at most n rows per
    topic (``WindowGroupLimit`` keeps a hot topic from shipping more).
    """
    keys = [topic] if isinstance(topic, str) else list(topic)
    base = df.where(F.col(keys[-1]).isNotNull())
    # Sizes are sums of the (topic, industry) counts, so both come from one scan and one
    # grouped count (the shared exchange is reused); only the samples read the text.
    counts = base.groupBy(*keys, industry).agg(F.count(F.lit(1)).alias("__n"))
    sizes = counts.groupBy(*keys).agg(F.sum("__n").alias("size"))

    ind = top_n(counts.where(F.col(industry).isNotNull()), keys,
                [F.desc("__n"), F.col(industry)], n_industries, "__r")
    ind = ind.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col("__r"), F.concat(F.col(industry), F.lit("("), F.col("__n").cast("string"), F.lit(")"))
        .alias("s")))).alias("__l"))
    ind = ind.select(*keys, F.transform("__l", lambda x: x["s"]).alias("top_industries"))

    smp = base.select(*keys, doc, F.length(text).alias("__len"),
                      sample_text(text, sample_chars).alias("__s"))
    smp = top_n(smp, keys, [F.col("__len"), F.col(doc)], n_samples, "__r")
    smp = smp.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__r", "__s"))).alias("__l"))
    smp = smp.select(*keys, F.transform("__l", lambda x: x["__s"]).alias("samples"))

    brief = sizes.join(ind, keys, "left").join(smp, keys, "left")
    if keywords is not None:
        terms = keywords.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("__l"))  # n terms a topic
        brief = brief.join(terms.select(*keys, F.transform("__l", lambda x: x["term"]).alias("keywords")), keys, "left")
    return brief


def brief_lines(brief: DataFrame, industries: DataFrame, industry: str, levels: Sequence[str]) -> DataFrame:
    """K7: the naming brief as ordered text lines (part, topic, line): industry counts, then each topic of each level.

    ``brief``: (level, topic, size, top_industries, keywords, samples); ``industries``: (industry, n).
    """
    head = [industries.select(F.lit(0).alias("part"), (-F.col("n")).alias("topic"), F.concat_ws("", F.col(industry), F.lit(": "), F.col("n"))
                              .alias("text"))]
    rule = F.lit("-" * 60)
    for i, level in enumerate(levels, 1):
        one = brief.where(F.col("level") == level)
        lines = F.concat_ws("\n", rule, F.format_string(f"[{level} topic %02d] (%d documents)", F.col("topic").cast("int"), F.col("size").cast("long")),
                            F.concat(F.lit("  industries: "), F.coalesce(F.array_join("top_industries", ", "), F.lit(""))),
                            F.concat(F.lit("  keywords: "), F.coalesce(F.array_join("keywords", ", "), F.lit(""))), F.lit("  samples:"),
                            F.array_join(F.transform(F.coalesce("samples", F.array().cast("array<string>")), lambda x: F.concat(F.lit("    * "), x)), "\n"), F.lit("  name: "))
        head.append(one.select(F.lit(i).alias("part"), F.col("topic").cast("long").alias("topic"), lines.alias("text")))
    out = head[0]
    for h in head[1:]:
        out = out.unionByName(h)
    return out.orderBy("part", "topic", "text")


def label_template(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """K8: one row holding {level: {cluster id: ""}} for every non-empty cluster, as JSON.

    One aggregate; each id set is bounded by the number of clusters of its level.
    """
    ids = df.agg(*[F.array_sort(F.collect_set(F.col(lv).cast("string"))).alias(lv) for lv in levels])
    maps = [F.map_from_arrays(F.col(lv), F.transform(F.col(lv), lambda _: F.lit(""))).alias(lv)
            for lv in levels]
    return ids.select(F.to_json(F.struct(*maps)).alias("template"))


def dominant(df: DataFrame, child: str, parent: str, out: str | None = None,
             weight: str | None = None) -> DataFrame:
    """Per child value, its most frequent non-null parent; ties -> smallest value.

    With ``weight`` each row counts as that many (rows of a pre-aggregated table).
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    c = (df.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
         .groupBy(child, parent).agg(n.alias("__n")))
    pick = F.min_by(F.col(parent), F.struct(-F.col("__n"), F.col(parent)))
    return c.groupBy(child).agg(pick.alias(out or f"dominant_{parent}"))


def _palette_color(idx: Column, palette: Sequence[str]) -> Column:
    arr = F.array(*[F.lit(p) for p in palette])
    return F.element_at(arr, (F.pmod(idx, F.lit(len(palette))) + 1).cast("int"))


def tree_nodes(df: DataFrame, industry: str, medium: str, fine: str,
               palette: Sequence[str] = INDUSTRY_PALETTE) -> DataFrame:
    """The root -> industry -> medium -> fine tree.

    Columns: id, label, parent, level, count (true rows), value (rolled up so that a
    parent is at least the sum of its children), color, share (value / parent value).
    """
    # The only document-sized step: one grouped count per (industry, medium, fine).
    # Every node count and dominant parent below is a sum over this small table, which
    # is materialised once in the checkpoint folder (its size is bounded by industries x
    # topics, not by the number of documents).
    cube = cut_lineage(df.groupBy(industry, medium, fine).agg(F.count(F.lit(1)).alias("__c")))
    n_root = cube.agg(F.sum("__c").cast("bigint").alias("count"))
    root = n_root.select(F.lit(ROOT_ID).alias("id"), F.lit(ROOT_LABEL).alias("label"),
                         F.lit("").alias("parent"), F.lit("root").alias("level"),
                         F.coalesce(F.col("count"), F.lit(0).cast("bigint")).alias("count"),
                         F.lit(ROOT_COLOR).alias("color"))

    ind = (cube.where(F.col(industry).isNotNull()).groupBy(industry)
           .agg(F.sum("__c").cast("bigint").alias("count")))
    # Ordinal over the distinct industries only (dimension-sized global window).
    ind = ind.withColumn("__i", F.row_number().over(Window.orderBy(industry)) - 1)
    ind = ind.withColumn("color", _palette_color(F.col("__i"), palette))
    ind_nodes = ind.select(F.concat(F.lit(INDUSTRY_PREFIX), F.col(industry)).alias("id"),
                           F.col(industry).cast("string").alias("label"), F.lit(ROOT_ID).alias("parent"),
                           F.lit("industry").alias("level"), "count", "color")
    ind_color = ind.select(F.col(industry).cast("string").alias("__dom"), F.col("color").alias("__pc"))

    def level_nodes(child: str, parent: str, parent_prefix: str, prefix: str,
                    level: str, parent_colors: DataFrame) -> DataFrame:
        cnt = (cube.where(F.col(child).isNotNull()).groupBy(child)
               .agg(F.sum("__c").cast("bigint").alias("count")))
        dom = dominant(cube, child, parent, "__dom", weight="__c").withColumn(
            "__dom", F.col("__dom").cast("string"))
        j = cnt.join(dom, child, "left").join(parent_colors, "__dom", "left")
        return j.select(F.concat(F.lit(prefix), F.col(child).cast("string")).alias("id"),
                        F.col(child).cast("string").alias("label"),
                        F.concat(F.lit(parent_prefix), F.col("__dom").cast("string")).alias("parent"),
                        F.lit(level).alias("level"), "count",
                        F.coalesce(F.col("__pc"), F.lit(FALLBACK_COLOR)).alias("color"))

    med_nodes = level_nodes(medium, industry, INDUSTRY_PREFIX, MEDIUM_PREFIX, "medium", ind_color)
    med_color = med_nodes.select(F.col("label").alias("__dom"), F.col("color").alias("__pc"))
    fin_nodes = level_nodes(fine, medium, MEDIUM_PREFIX, FINE_PREFIX, "fine", med_color)
    nodes = cut_lineage(root.unionByName(ind_nodes).unionByName(med_nodes).unionByName(fin_nodes))
    return with_share(roll_up(nodes))


LEVEL_ORDER = ["fine", "medium", "industry", "root"]


def roll_up(nodes: DataFrame, levels: Sequence[str] = LEVEL_ORDER) -> DataFrame:
    """value = max(count, sum of children values), computed bottom-up one level at a time.

    One bottom-up pass equals the original repeated repair passes over a 4-level tree.
    ``nodes`` is topic-sized (industries + topics), never document-sized.
    """
    done = nodes.where(F.col("level") == levels[0]).withColumn("value", F.col("count"))
    prev = done
    for lv in levels[1:]:
        sums = prev.groupBy(F.col("parent").alias("id")).agg(F.sum("value").alias("__cs"))
        cur = (nodes.where(F.col("level") == lv).join(sums, "id", "left")
               .withColumn("value", F.greatest(F.col("count"), F.coalesce(F.col("__cs"), F.lit(0))))
               .drop("__cs"))
        done = done.unionByName(cur)
        prev = cur
    return done


def with_share(nodes: DataFrame) -> DataFrame:
    """P20: value / parent value (null for the root)."""
    par = nodes.select(F.col("id").alias("__pid"), F.col("value").alias("__pv"))
    j = nodes.join(par, nodes["parent"] == par["__pid"], "left")
    return j.withColumn("share", F.try_divide(F.col("value").cast("double"), F.col("__pv"))) \
            .drop("__pid", "__pv")
