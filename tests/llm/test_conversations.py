"""Conversation repair against a plain search over the grammar's states, and edge cases."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import conversations
from tidemark.llm.conversations import plan_repair

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}  # 0 and 3 may end
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_repair(initials, forced, cut):
    """All cheapest audits of every state of the grammar, without a target length."""
    def offer(best, state, cost, audits):
        if state not in best or cost < best[state][0]:
            best[state] = (cost, set(audits))
        elif cost > best[state][0] or audits <= best[state][1]:
            return False
        else:
            best[state] = (cost, best[state][1] | audits)
        return True

    def inserted(best):
        more = True
        while more:
            more = False
            for state in list(best):
                cost, audits = best[state]
                for c, to in NEXT[state].items():
                    more |= c != "s" and offer(best, to, cost + 2, {a + "I" for a in audits})
        return best

    now = inserted({0: (0, {""})})
    for x, gone, short in zip(initials, forced, cut, strict=True):
        then = {}
        for state, (cost, audits) in now.items():
            offer(then, state, cost + 3, {a + "D" for a in audits})
            for c, to in NEXT[state].items() if not gone else ():
                if c == x:
                    offer(then, to, cost + int(short), {a + "K" for a in audits})
                elif c != "s":
                    offer(then, to, cost + 2 + int(short), {a + "R" for a in audits})
        now = inserted(then)
    ends = [now[s] for s in (0, 3) if s in now]
    least = min(c for c, _ in ends)
    return least, min(min(a) for c, a in ends if c == least)


def plain_report(rows):
    """The contract's rows from (conv_id, turn, role, text), row by row."""
    after = {}
    for conv, turn, role, text in rows:
        own = after.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        if d == 1:
            text = ""
        elif d == 2:
            text = "".join(c for c in text if c not in ".!?")
        role = "user" if d == 4 else role
        own += [] if d == 0 else [(turn, role, text)] * (2 if d == 3 else 1)
    out = []
    for conv, own in after.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(SPACES)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = plain_repair(initials, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        lines, i, ask = [], 0, "u"
        for e in audit:
            fill = "user" if ask == "u" else "assistant"
            if e != "D":
                lines.append(f"{fill}:" if e == "I" else f"{own[i][1] if e == 'K' else fill}:{own[i][2]}")
                if not (e == "K" and initials[i] == "s"):
                    ask = "a" if ask == "u" else "u"
            i += e != "I"
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                    sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def spark_report(df):
    return sorted((tuple(r) for r in conversations.report(df).select(*COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_alignment_equals_plain_search():
    rng = random.Random(1)
    for _ in range(600):
        n = rng.randint(1, 9)
        initials = "".join(rng.choice("uuuaaasx") for _ in range(n))
        forced, cut = np.asarray([rng.random() < 0.15 for _ in range(n)]), np.asarray([rng.random() < 0.3 for _ in range(n)])
        assert plan_repair(initials, forced, cut) == plain_repair(initials, forced, cut), initials


def test_long_conversations_keep_few_rows_of_the_table():
    rng = random.Random(2)
    initials = "s" + "".join(c for c in "ua" * 150 if rng.random() > 0.03)
    forced, cut = np.asarray([rng.random() < 0.04 for _ in initials]), np.asarray([rng.random() < 0.1 for _ in initials])
    cost, audit = plan_repair(initials, forced, cut)
    roles, i = [], 0
    paid = {"K": 0, "R": 2, "D": 3, "I": 2}
    total = 0
    for e in audit:
        total += paid[e] + (e in "KR" and bool(cut[i]))
        roles.append({"K": initials[i] if i < len(initials) else "", "I": "?", "R": "?", "D": ""}[e])
        assert not (e in "KR" and forced[i])
        i += e != "I"
    assert i == len(initials) and total == cost
    kept = "".join(roles)
    kept = kept[1:] if kept.startswith("s") else kept
    assert len(kept) % 2 == 0 and all(c in ("?", "ua"[k % 2]) for k, c in enumerate(kept))


def test_conversations_equal_plain(spark):
    for sf in (SF_SMALL, "/root/testdata/sf0.01"):
        df = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
        assert spark_report(df) == plain_report([tuple(r) for r in df.collect()])


def test_conversation_edges(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(-3, 12)]), rng.choice([None, *range(5)]), rng.choice([None, "", "user", "assistant", "system", "tool", "ünder"]),
             rng.choice([None, "", " \t", "Yes.", "no", "wait!?", "x" * 50 + ".", "ünï. "])) for _ in range(120)]
    rows += [(50, 1, "user", "long " * 200_000), (50, 2, "assistant", "a.\n\x0b "), (51, 0, "system", "only."), (51, 0, "system", "only.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert spark_report(df.withColumn("digest", F.lit(1)).withColumn("audit", F.lit("x")).withColumn("o", F.lit(0))) == plain_report(rows)
    assert conversations.report(df.filter("conv_id > 99")).count() == 0
    dropped = next((c, t) for c in range(60, 99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(*dropped, "user", "Hi.")], df.schema)
    assert spark_report(one) == [(dropped[0], 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_repaired_turns_are_the_hashed_ones(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows, audits = conversations.repair(df)
    turns = {}
    for r in conversations.repaired_turns(rows, audits).collect():
        turns.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for r in conversations.report(df).collect():
        text = "\n".join(t for _, t in sorted(turns.get(r["conv_id"], [])))
        assert sha256(text.encode()).hexdigest() == r["repaired_sha256"]
