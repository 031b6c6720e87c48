"""Harmonic packing of documents into sequences of fixed capacity.

A piece of at most C/k and over C/(k+1) tokens is of class k, and a sequence of class k
takes k pieces of that class, so each worker fills its classes without knowing the others.
Since documents may be cut, a document gives whole sequences first; a rest that would
waste more than ``WASTE_PCT`` of its slot is cut at the next lower slot size C/(k+1), which
fills that slot fully.  At the end of a partition the pieces of sequences that are not yet
full are laid one after another and cut at the capacity: one sequence per partition at
most is much padded.

Edge cases: null and empty texts are the end id alone; copies, ties and repeated rows are
packed row by row; rows without a doc_id are packed with a null doc_id; a very long text
gives many full sequences; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, tidy
from .tokenizing import encoder, slices

CAPACITY = 4096
END_ID = 2
#: A rest may leave this share of its slot empty before it is cut.
WASTE_PCT = 2
#: Rests under this length are not cut.
MIN_CUT = 256
#: Sequence ids: the partition's number above this many bits, a count below.
COUNT_BITS = 33

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` ids, in order."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        slot = capacity // k
        if rest < MIN_CUT or 100 * (slot - rest) <= WASTE_PCT * slot:
            out.append((rest, k))
            break
        out.append((capacity // (k + 1), k + 1))
        rest -= capacity // (k + 1)
    return out


class Packer:
    """The open sequences of one partition; ``add`` and ``flush`` give finished rows."""

    def __init__(self, partition: int, capacity: int = CAPACITY):
        self.capacity, self.next, self.open = capacity, partition << COUNT_BITS, defaultdict(list)

    def _close(self, pieces) -> list[tuple]:
        sequence, at, out = self.next, 0, []
        self.next += 1
        for doc, start, ids, total in pieces:
            out.append((doc, start, len(ids), ids.tobytes(), total, sequence, at))
            at += len(ids)
        return out

    def add(self, doc, ids: np.ndarray) -> list[tuple]:
        out, at = [], 0
        for n, k in cut_points(len(ids), self.capacity):
            held = self.open[k]
            held.append((doc, at, ids[at:at + n], len(ids)))
            at += n
            if len(held) == k:
                out += self._close(held)
                del self.open[k]
        return out

    def flush(self) -> list[tuple]:
        out, held, room = [], [], self.capacity
        for k in sorted(self.open):
            for doc, start, ids, total in self.open[k]:
                while len(ids):
                    part = ids[:room]
                    held.append((doc, start, part, total))
                    start, ids, room = start + len(part), ids[len(part):], room - len(part)
                    if not room:
                        out += self._close(held)
                        held, room = [], self.capacity
        self.open.clear()
        return out + (self._close(held) if held else [])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``ids`` holds its token ids as little-endian unsigned 32-bit.

    Each partition of ``docs`` packs on its own, in its rows' order: no shuffle, and a
    task that is run again gives the same pieces.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(tokenizer), Packer(TaskContext.get().partitionId(), capacity)
        end = np.asarray([end_id], "<u4")
        for b in batches:
            docs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for a, z in slices(texts):
                rows = []
                for doc, ids in zip(docs[a:z], enc.ids(texts[a:z]), strict=True):
                    rows += packer.add(doc, np.concatenate((ids, end)))
                if rows:
                    yield table(rows)
        if rows := packer.flush():
            yield table(rows)

    return doc_texts(docs).mapInArrow(tidy(run), SCHEMA)


def pack_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of the ids."""
    return pack(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
