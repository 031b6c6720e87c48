"""Conversation structure repair: the cheapest edits that make the roles alternate.

A repaired conversation has the role initials ``(s?(ua)+)?``.  The turns of a conversation
are aligned with each feasible length of that string (Wagner-Fischer): keeping a turn costs
nothing, another role 2, deleting it 3, inserting an empty turn 2; turns that are blank or
repeat an earlier one must go, and a kept turn whose text is cut off adds 1.  The incumbent
is the cost of a greedy repair; lengths and cells that cannot stay within it lie outside a
band around the diagonal (Ukkonen) and are not computed.  The tables of all lengths are one
table, since counted from the end each string begins like the longer ones.  For each of the
cheapest lengths the ASCII-least audit is traced, and the least of those is taken.

Spark shuffles twice by conversation.  The first time only codes and digests of the turns
come together, sorted, and each conversation is aligned from one byte a turn.  The second
time the texts follow their conversation's audit and are hashed as they stream by, so no
task holds a conversation's texts.  The table of an alignment is kept for some rows only
and built again between them when the audit is traced: memory grows with the square root
of a conversation's turns times the band.

Edge cases: a null in any column is one space, so null ids are one conversation and a null
turn takes no part in the gaps; turns of equal number are ordered by role and by
the digest of their text, so equal rows are neighbours; an empty table gives no rows; a
conversation whose rows are all dropped has zeros, an empty audit and the hash of the empty
text; texts are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE_CLASS, SPACE_CHARS, staged

#: Fixed values of the contract: what an edit costs, and the end marks.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
_MARKS = "[.!?]"
_ROLES = {"u": "user", "a": "assistant"}
#: Blank, duplicate or truncated, as the first fault of a turn.
_FAULTS = ("blank", "duplicate", "truncated")
_FAR = 1 << 29
#: Columns of the result.
_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): the rows after damage; dropped rows keep their ids only."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                (F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20).alias("d"),
                                plain("role").alias("role"), plain("text").alias("text"))
    text = F.when(F.col("d") <= 1, "").when(F.col("d") == 2, F.regexp_replace("text", _MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("d") == 0).alias("dropped"),
                       copies.alias("c")).withColumn("copy", F.explode("c")).drop("c", "copy")


def _codes(rows: DataFrame) -> DataFrame:
    """The rows without their texts: first of the role, digest, and whether blank or cut off."""
    end = F.substring(F.rtrim("text", F.lit(SPACE_CHARS)), -1, 1)
    return rows.select("conv_id", "turn", "role", "dropped", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                       (~F.col("text").rlike(NON_SPACE_CLASS)).alias("blank"), (~end.rlike(_MARKS)).alias("cut_off"))


def plan_repair(initials: str, forced: np.ndarray, cut_off: np.ndarray) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of one conversation.

    ``initials``: one character a turn; ``forced``: turns that must go; ``cut_off``: turns
    that add 1 when they stay.
    """
    n = len(initials)
    must = 3 * int(forced.sum()) + int((cut_off & ~forced).sum())
    stay = np.r_[np.cumsum((~forced)[::-1])[::-1], 0]  # turns that may stay, from each place on
    # The incumbent: insert where the roles do not alternate, give other roles the one asked for.
    ask, breaks = "u", 0
    for i in np.flatnonzero(~forced).tolist():
        c = initials[i]
        if c in "ua" and c != ask:
            breaks, ask = breaks + 1, c
        elif c not in "ua":
            breaks += 1
        ask = "a" if ask == "u" else "u"
    breaks += ask == "a"
    # Off the diagonal by w, a path costs 2 w more than what every repair pays: rows of the
    # table hold the last stay[i] - w to stay[i] + w symbols.
    w = breaks
    rows = max(1, isqrt(n))
    width = 2 * w + 1
    span = np.arange(width)
    step = INSERT * span
    is_u = np.asarray([c == "u" for c in initials])
    is_a = np.asarray([c == "a" for c in initials])

    def before(i: int, below: np.ndarray) -> np.ndarray:
        """Row i of the costs to the end from row i + 1."""
        low = stay[i] - w
        if forced[i]:
            return below + DELETE  # the same symbols remain
        # Turn i may stay: the band has moved by one symbol.
        remain = low + span
        gone = np.r_[below[1:], _FAR] + DELETE
        matched = np.where(remain % 2 == 1, is_a[i], is_u[i])
        kept = below + np.where(matched, 0, REROLE) + (CUT_OFF if cut_off[i] else 0)
        best = np.minimum(gone, np.where(remain >= 1, kept, _FAR))
        best[remain < 0] = _FAR
        return np.minimum.accumulate(best - step) + step

    now = np.full(width, _FAR)
    now[w:] = INSERT * (span[w:] - w)
    marks, ends = {n: now}, []
    for i in range(n - 1, -1, -1):
        if initials[i] == "s" and not forced[i] and DELETE * i <= must + INSERT * breaks:
            # A leading system turn: those before it go, it stays, the others fill (ua)+.
            paid, low = DELETE * i + (CUT_OFF if cut_off[i] else 0), int(stay[i + 1]) - w
            ends += [(int(now[k]) + paid, low + k, i) for k in range(max(0, 2 - low), width) if (low + k) % 2 == 0]
        now = before(i, now)
        if i % rows == 0:
            marks[i] = now
    low = int(stay[0]) - w
    ends += [(int(now[k]), low + k, None) for k in range(max(0, -low), width) if (low + k) % 2 == 0]
    cost = min(c for c, _, _ in ends)
    best = None
    for _, length, system in (e for e in ends if e[0] == cost):
        audit = _trace(n, length, system, initials, stay, w, rows, marks, before)
        best = audit if best is None or audit < best else best
    assert best is not None and cost <= must + INSERT * breaks
    return cost, best


def _trace(n, length, system, initials, stay, w, rows, marks, before) -> str:
    """The ASCII-least audit of this length: from the front, the least letter that stays cheapest."""
    out: list[str] = []
    i, r = 0, length
    if system is not None:
        out += ["D" * system, "K"]
        i = system + 1
    block: dict[int, np.ndarray] = {}

    def cell(i: int, r: int) -> int:
        k = r - (int(stay[i]) - w)
        if not 0 <= k <= 2 * w or r < 0:
            return _FAR
        if i in marks:
            return int(marks[i][k])
        if i not in block:
            block.clear()
            top = min(n, (i // rows + 1) * rows)
            now = marks[top]
            for j in range(top - 1, i - i % rows, -1):
                now = block[j] = before(j, now)
        return int(block[i][k])

    while i < n or r > 0:
        here = cell(i, r)
        if i < n and cell(i + 1, r) + DELETE == here:
            out.append("D")
            i += 1
        elif r > 0 and cell(i, r - 1) + INSERT == here:
            out.append("I")
            r -= 1
        else:
            out.append("K" if initials[i] == ("a" if r % 2 else "u") else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def _audits(codes: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost and audit."""
    names = ["conv_id", *[c.split()[0] for c in _STATS.split(", ")]]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def close(conv, turns: list, counts: dict, initials: list, forced: list, cut: list) -> tuple:
        spread = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
        cost, audit = plan_repair("".join(c or " " for c in initials), np.asarray(forced, bool), np.asarray(cut, bool)) if initials else (0, "")
        return (conv, spread, *[counts[f] for f in _FAULTS], pairs, cost, audit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv = False, None
        for b in batches:
            out = []
            for cid, turn, role, dropped, digest, blank, cut_off in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not started or cid != conv:
                    if started:
                        out.append(close(conv, turns, counts, initials, forced, cut))
                    started, conv = True, cid
                    turns, counts, initials, forced, cut, seen = [], dict.fromkeys(_FAULTS, 0), [], [], [], set()
                if dropped:
                    continue
                if turn is not None:
                    turns.append(turn)
                own = sha256(f"{role}:{digest}".encode()).digest()[:16]
                fault = "blank" if blank else "duplicate" if own in seen else "truncated" if cut_off else None
                seen.add(own)
                if fault:
                    counts[fault] += 1
                initials.append(role[:1])
                forced.append(fault in ("blank", "duplicate"))
                cut.append(fault == "truncated")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        if started:
            last = [close(conv, turns, counts, initials, forced, cut)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*last, strict=True), kinds, strict=True)], names)

    ordered = codes.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.select("conv_id", "turn", "role", "dropped", "digest", "blank", "cut_off").mapInArrow(run, f"conv_id long, {_STATS}")


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of the repaired conversations, in order.

    ``edit`` is K, R or I; deleted turns are left out.
    """
    return _applied(rows, audits, False)


def _applied(rows: DataFrame, audits: DataFrame, hashed: bool) -> DataFrame:
    """The audits applied to the turns that follow them: the turns themselves, or their hash."""
    if hashed:
        names, kinds, schema = ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()], "conv_id long, repaired_sha256 string"
    else:
        names, kinds = ["conv_id", "place", "edit", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        schema = "conv_id long, place long, edit string, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, ask, digest = None, None, 0, 0, "u", sha256()

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, ask
            if hashed:
                digest.update((("\n" if place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            else:
                out.append((conv, place, edit, role, text))
            place += 1
            if role[:1] != "s" or place > 1:
                ask = "a" if ask == "u" else "u"

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put("I", _ROLES[ask], "")
                at += 1

        def done() -> None:
            if audit is not None:
                insert()
                if hashed:
                    out.append((conv, digest.hexdigest()))

        for b in batches:
            out: list[tuple] = []
            for cid, first, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if first is not None:
                    done()
                    conv, audit, at, place, ask, digest = cid, first, 0, 0, "u", sha256()
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put("K", role, text)
                elif edit == "R":
                    put("R", _ROLES[ask], text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        out = []
        done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    none = F.lit(None)
    turns = rows.filter(~F.col("dropped")).select("conv_id", F.lit(1).alias("o"), "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                                                  none.cast("string").alias("audit"), "text")
    heads = audits.select("conv_id", F.lit(0).alias("o"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("digest"),
                          "audit", none.cast("string").alias("text"))
    ordered = heads.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "o", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(run, schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows after damage, audits): what ``repaired_turns`` takes."""
    rows = damaged(conversations)
    return rows, staged(_audits(_codes(rows)), "conversation-audits")


def report(conversations: DataFrame) -> DataFrame:
    """The contract's row per conversation: faults, cost, audit and the hash of the repaired turns."""
    rows, audits = repair(conversations)
    return audits.join(_applied(rows, audits, True).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
