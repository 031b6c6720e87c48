"""Resumable incremental ingest (X1, K4, J5, W5) as a Structured Streaming job.

Landed article files are read with the streaming file source; the streaming
checkpoint is the done-set, so a restarted job resumes after the last committed
micro-batch and a second run over the same files adds nothing.

The sink is an append-only claim log.  A state store keyed by URL holds the order of the
best claim so far (``new_claims``), so each micro-batch appends only claims that are new or
beat the logged one, without reading the log.  The table readers see is ``claimed(log)``: per
URL the claim with the smallest finder order.  That result does not depend on file arrival
order or batch boundaries, and a batch replayed after a failure starts from the state of the
batch before it and re-appends rows that the view collapses, so the job survives the loss of
executors or of the driver.  Unlike a per-run memory of seen URLs, the state remembers URLs
across restarts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.dedupe import claim


def _state_fields(schema, order: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, schema[c].dataType) for c in order])


def _rank(values: Sequence) -> tuple:
    """Order values as Spark compares structs: nulls first."""
    return tuple((v is not None, v) if v is not None else (False, 0) for v in values)


def new_claims(stream: DataFrame, url: str, order: Sequence[str]) -> DataFrame:
    """The rows of a stream that claim their URL, or take it from a later finder.

    The state store holds, for each URL, the order of the best claim so far and nothing else,
    so a batch touches the URLs that it has and its work does not grow with the log.  A URL
    with many finders comes in pieces, of which the best row is kept.
    """
    def values(column: pd.Series) -> list:
        return [None if v is None or v != v else v for v in column.tolist()]

    def best(_: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        row = own = None
        for piece in pieces:
            for i, found in enumerate(zip(*[values(piece[c]) for c in order], strict=True)):
                if row is None or _rank(found) < _rank(own):
                    row, own = piece.iloc[[i]], found
        if not state.exists or _rank(own) < _rank(state.get):
            state.update(tuple(own))
            yield row

    return stream.groupBy(url).applyInPandasWithState(best, stream.schema, _state_fields(stream.schema, order), "update", GroupStateTimeout.NoTimeout)


def claimed(spark: SparkSession, sink: str, url: str = "url",
            order: Sequence[str] = ("stock_id", "doc_id"), fmt: str = "parquet") -> DataFrame:
    """The ingested table: per URL the logged claim of the first finder."""
    return claim(spark.read.format(fmt).load(sink), url, list(order))


def resume_ingest(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                  url: str = "url", order: Sequence[str] = ("stock_id", "doc_id"),
                  batch_bytes: int = 1 << 30, fmt: str = "parquet") -> int:
    """Ingest every landed file not yet processed, about ``batch_bytes`` of files per
    micro-batch, then stop (``availableNow``).

    Returns the number of micro-batches of this run (0 when nothing new had landed).
    """
    seen: set[int] = set()

    def each(batch: DataFrame, batch_id: int) -> None:  # K4
        batch.write.mode("append").format(fmt).save(sink)
        seen.add(batch_id)

    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).format(fmt).load(source)
    q = (new_claims(stream, url, list(order)).writeStream.foreachBatch(each).outputMode("update")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(seen)


def share_of_files(spark: SparkSession, source: str, schema, batches: int, least: int, fmt: str = "parquet") -> int:
    """Bytes of a micro-batch, ``least`` at least, with which the landed files make about ``batches`` of them.

    A micro-batch has its fixed cost (a commit of every state partition), so their number must not follow the input.
    """
    files = spark.read.schema(schema).format(fmt).load(source).select("_metadata.file_path", "_metadata.file_size").distinct()
    return max(least, -(-(files.selectExpr("sum(file_size)").first()[0] or 0) // batches))


def land_files(df: DataFrame, target: str, rows_per_file: int = 1_000_000) -> str:
    """Land a table as files of at most ``rows_per_file`` rows, so their number follows the
    input; every task writes the rows it has read, so no key is gathered and nothing shuffles."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)
    return target
