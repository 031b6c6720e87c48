"""Helpers shared by the operators: inputs, staged tables, lambdas over one value."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: The word separators, U+0020 and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
NON_SPACE_CLASS = r"[^\x20\x09-\x0D]"


def text_of(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null as empty) only, so no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and go on from the copy.

    A lost executor then costs the readers nothing, and branches do not repeat the work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, with underscores behind it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key() -> Column:
    """64-bit hash of a row's doc_id and text: rows with the same key are repeated rows."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_of())


#: What the operators of this worker keep between tasks.
_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """This worker's cache of ``owner``; those of other operators, which ran before, are dropped."""
    for other in [k for k in _KEPT if k != owner]:
        del _KEPT[other]
    return _KEPT.setdefault(owner, {})


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after whose end the worker gives free memory back.

    Workers outlive their tasks and stages; what their pools hold back would add up over
    a chain of stages.
    """
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return tidied


#: A key with more than this part of all rows is joined apart.
HOT_PART = 1_000


def join_sized(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left joined with ``table``, which has one row per key and the number of its rows as ``size``.

    Keys with over 1 / HOT_PART of all rows, of which there are at most HOT_PART, are sent to
    the rows instead of gathering them; the others meet their row by a shuffle.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(table.filter(F.col(size) * HOT_PART > total).drop(size))
    cold = table.filter(F.col(size) * HOT_PART <= total).drop(size)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, "left"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside nested lambdas.

    Catalyst may inline an expression into a lambda, which would evaluate it again for
    each element; a one-element array binds it to a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; an empty array if there are none."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the smallest hashes of ``keys``.

    A hash limit from the number of rows leaves about one and a half times as many for the
    final order, however large ``df`` is.
    """
    n = df.count()
    h = F.xxhash64(*keys)
    if n > 2 * rows:
        df = df.filter(h < int(-(1 << 63) + (1 << 64) * 1.5 * rows / n))
    return df.orderBy(h, *keys).limit(rows)
