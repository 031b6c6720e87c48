"""The topic workflow end to end, as the original runs it in one script.

Articles ⟕ stocks (industry) → clean → embed (keyed cache) → reduce → two-level Ward
topics → stage tables → briefs and label template (phase 1); labels → topic x industry
tables, result projection and topic tree (phase 2).  Every step is one of the package's
DataFrame operators; the stage tables are written to a run folder under the shared
checkpoint root and read back, which cuts the lineage between the costly clustering and
the many small reports built on it, and lets phase 2 run later from the same stage.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import DEFAULT_INDUSTRY, LEVELS, REDUCED_DIMS
from ..functions.text import clean_text, has_text, strip
from ..operators import cluster, hierarchy, keywords, rollup, segment
from ..operators.dims import with_industry
from ..sources.readers import read_stage
from ..sources.sinks import write_stage

ENCODER_ID = "clean-v1/hashed-1024"


def cluster_phase(spark: SparkSession, articles: DataFrame, stocks: DataFrame, run_root: str,
                  levels: dict[str, int] = LEVELS, leaves: int | None = None,
                  dims: int = REDUCED_DIMS, cache_path: str | None = None,
                  stock_order: str = "industry_name") -> DataFrame:
    """Phase 1 up to the stage table: (doc_id, stock_id, industry_name, text, x, y,
    cluster_<level>...).  ``articles`` has doc_id, stock_id, text; ``stocks`` a code
    column and industry_name; of several rows of a code the last by ``stock_order`` counts."""
    arts = with_industry(articles.where(has_text("text")), stocks, "stock_id", DEFAULT_INDUSTRY, order=stock_order)
    cache = cache_path or cluster.cache_folder(spark)
    emb = cluster.embed_cached(spark, arts.select("doc_id", "text"), cache, ENCODER_ID,
                               prepare=lambda c: clean_text(strip(c)))
    red = cluster.reduce(emb.select("doc_id", "embedding"), "embedding", dims, "features")
    # Stage the reduced features (doc_id + a few doubles, far smaller than the text): the
    # clustering makes several passes over them, and each would otherwise re-run the
    # scan, cleaning-cache join and projection.
    write_stage(red.select("doc_id", vector_to_array("features").alias("features")), run_root, "run",
                "features")
    red = read_stage(spark, run_root, "run", "features")
    xy = cluster.reduce(red, "features", 2, "__xy")
    topics, merges = hierarchy.ward_topics(spark, red, "doc_id", "features", levels, leaves)
    xy = xy.select("doc_id", vector_to_array("__xy")[0].alias("x"), vector_to_array("__xy")[1].alias("y"))
    docs = (arts.withColumn("text", clean_text(strip("text")))
            .join(topics, "doc_id").join(xy, "doc_id"))
    write_stage(docs, run_root, "run", "documents")
    write_stage(merges, run_root, "run", "merges")
    return read_stage(spark, run_root, "run", "documents")


def briefs(docs: DataFrame, levels: dict[str, int] = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Phase 1 reports: per-topic brief with keywords at every level, and the label template."""
    lv = F.explode(F.array(*[F.struct(F.lit(name).alias("level"), F.col(f"cluster_{name}").alias("topic"))
                             for name in levels])).alias("__lv")
    both = docs.select("*", lv).select("*", "__lv.level", "__lv.topic").drop("__lv")
    words = keywords.topic_keywords(segment.segmented_tokens(docs, "text"), {n: f"cluster_{n}" for n in levels}, "doc_id", "tokens")
    brief = rollup.topic_brief(both, ["level", "topic"], "industry_name", "text", "doc_id", words)
    template = rollup.label_template(docs.select(*[F.col(f"cluster_{n}").alias(n) for n in levels]),
                                     list(levels))
    return brief, template


def brief_lines(docs: DataFrame, brief: DataFrame, levels: dict[str, int] = LEVELS) -> DataFrame:
    """K7: the brief to read while naming: industry counts, then the topics of every level, the finest first."""
    return rollup.brief_lines(brief, rollup.industry_counts(docs, "industry_name"), "industry_name", list(levels)[::-1])


def with_labels(docs: DataFrame, labels: DataFrame | None, levels: dict[str, int] = LEVELS) -> DataFrame:
    """``label_<level>`` per document; without a label file a topic's label is its id."""
    for name in levels:
        cid = f"cluster_{name}"
        if labels is None:
            docs = docs.withColumn(f"label_{name}", F.col(cid).cast("string"))
        else:
            lab = labels.where(F.col("level") == name).select(F.col("cluster").alias(cid), F.col("label").alias(f"label_{name}"))
            docs = docs.join(lab, cid, "left")
    return docs


def result(labelled: DataFrame, levels: dict[str, int] = LEVELS) -> DataFrame:
    """K2: the result projection of labelled documents, with their time where the articles have one."""
    time = [c for c in labelled.columns if c == "created_at"]
    return labelled.select("doc_id", "stock_id", "industry_name", *time, "x", "y",
                           *[f"cluster_{n}" for n in levels], *[f"label_{n}" for n in levels])


def matrices(labelled: DataFrame, levels: dict[str, int] = LEVELS) -> dict[str, DataFrame]:
    """K3: topic x industry table per level."""
    return {n: rollup.topic_matrix(labelled, f"label_{n}", "industry_name") for n in levels}


def tree(labelled: DataFrame, levels: dict[str, int] = LEVELS) -> DataFrame:
    """The topic tree from the first to the last level."""
    return rollup.tree_nodes(labelled, "industry_name", f"label_{list(levels)[0]}", f"label_{list(levels)[-1]}")
