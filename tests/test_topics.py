"""The topic workflow end to end on a small planted corpus."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.plans import topics as T
from tidemark.session import scratch_path

VOCAB = {
    0: "semiconductor wafer foundry chip lithography yield",
    1: "shipping container freight port vessel cargo",
    2: "bank loan deposit interest credit mortgage",
}


def corpus(n: int = 90):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        g = i % 3
        words = VOCAB[g].split()
        text = " ".join(rnd.choice(words) for _ in range(30)) + " https://example.com/x !!!"
        rows.append((i, f"s{g}{i % 2}", text))
    return rows


def test_cluster_and_label_phases(spark):
    arts = spark.createDataFrame(corpus(), "doc_id long, stock_id string, text string").withColumn("created_at", F.lit("2023-01-02").cast("timestamp"))
    stocks = spark.createDataFrame([("s00", "chips"), ("s01", "chips"), ("s10", "ships"), ("s11", "ships"),
                                    ("s20", "banks")], "stock_code string, industry_name string")
    root = scratch_path(spark, "topics-test")
    docs = T.cluster_phase(spark, arts, stocks, root, levels={"medium": 2, "fine": 3}, dims=5)
    pdf = docs.toPandas()
    assert len(pdf) == 90
    # Planted groups are recovered at the fine level, and fine topics nest in medium ones.
    groups = pdf.assign(g=pdf["doc_id"] % 3).groupby("cluster_fine")["g"].nunique()
    assert groups.max() == 1 and pdf["cluster_fine"].nunique() == 3
    assert pdf.groupby("cluster_fine")["cluster_medium"].nunique().max() == 1
    assert set(pdf["industry_name"]) == {"chips", "ships", "banks", "其他"}
    assert not pdf["text"].str.contains("https").any()

    brief, template = T.briefs(docs, {"medium": 2, "fine": 3})
    assert brief.where(F.col("level") == "fine").count() == 3
    assert '"fine"' in template.first()["template"]
    for r in brief.where("level = 'fine'").collect():  # keywords of the planted vocabulary
        assert set(r["keywords"][:3]) <= set(VOCAB[docs.where(F.col("cluster_fine") == r["topic"]).first()["doc_id"] % 3].split())
    lines = [r["text"] for r in T.brief_lines(docs, brief, {"medium": 2, "fine": 3}).collect()]
    assert lines[0].endswith(": 30") and "[fine topic 01] (30 documents)" in lines[4] and "[medium topic 01]" in lines[7] and len(lines) == 4 + 3 + 2
    assert "\n  keywords: " in lines[4] and lines[4].count("\n    * ") == 3 and lines[4].endswith("  name: ")

    labels = spark.createDataFrame([("fine", 1, "first"), ("medium", 1, "top")], "level string, cluster int, label string")
    levels = {"medium": 2, "fine": 3}
    out = T.with_labels(docs, labels, levels)
    res = T.result(out, levels).toPandas()
    assert res["created_at"].notna().all()
    assert len(res) == 90 and res["label_fine"].notna().sum() == (res["cluster_fine"] == 1).sum()
    m = T.matrices(out, levels)["fine"].collect()
    assert len(m) == 1 and m[0]["total"] == (res["cluster_fine"] == 1).sum()
    tree = {r["id"]: r for r in T.tree(T.with_labels(docs, None, levels), levels).collect()}
    assert tree["All"]["count"] == 90
