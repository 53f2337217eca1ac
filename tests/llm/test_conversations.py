"""Conversation repair against a search over all edits, on odd rows and across batches."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from filmweave.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, kind int, audit string"
NEXT = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}


def rows_of(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def after_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        here = found.setdefault(conv, [])
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        here += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return found


def brute(rows):
    """The cheapest edits of each conversation by trying all, least text first among equals."""
    out = []
    for conv, turns in after_damage(rows).items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            core = text.strip(" \t\n\x0b\f\r")
            faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "o")
            seen.add((role, text))

        @lru_cache(None)
        def rest(i, state, put, turns=turns, faults=faults):
            found = [(0, "", ())] if i == len(turns) and state in "0A" else []

            def add(cost, letter, said, more):
                if more:
                    found.append((cost + more[0], letter + more[1], said + more[2]))

            for role in ("user", "assistant"):
                if put < 3 and (state, role[0]) in NEXT:
                    add(2, "I", (f"{role}:",), rest(i, NEXT[state, role[0]], put + 1))
            if i < len(turns):
                _, own, text = turns[i]
                add(3, "D", (), rest(i + 1, state, 0))
                extra = faults[i] == "t"
                for role, letter, cost in ((own, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if faults[i] in "to" and (state, role[:1]) in NEXT:
                        add(cost + extra, letter, (f"{role}:{text}",), rest(i + 1, NEXT[state, role[:1]], 0))
            return min(found, default=None, key=lambda f: f[:2])

        cost, audit, said = rest(0, "0", 0)
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        text = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, text))
    return out


def repaired(df):
    return [tuple(r) for r in conversations.repair(conversations.damaged(df)).collect()]


def test_against_all_edits(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "universe"]
    texts = ["Hi there.", "So what? ", "no end", "x!\n", "  ", "", None, "Yes.", "née 1\n2."]
    rows = []
    for conv in range(300):
        for turn in range(rng.randint(1, 9)):
            at = rng.choice([turn, turn, turn + rng.randint(0, 3), None]) if conv % 3 == 0 else turn
            rows.append((conv or None, at, rng.choice(roles), rng.choice(texts)))
    rows += [(7000 + i, 0, "user", "Gone.") for i in range(60)]  # some lose their only row
    rows += rows[:40]
    rows += [(9_007_199_254_740_993, 9_007_199_254_740_995, "user", "big numbers."), (9_007_199_254_740_993, -5, "user", "long " * 50000)]
    got = repaired(rows_of(spark, rows).repartition(5))
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    assert any(r[7] == "" and r[6] == 0 for r in got)


def test_a_long_conversation_goes_on_across_batches_and_spills(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"turn {rng.randint(0, 90)}" + rng.choice([".", "", "!"])) for t in range(150)]
    rows += [(2, t, "user", "Again.") for t in range(30)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = repaired(rows_of(spark, rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("most", [2, 6, 1 << 20])
def test_choices_come_back_in_reverse(most):
    stack = conversations.Choices(most)
    pairs = [bytes((i % 256, i // 256)) for i in range(50)]
    for p in pairs:
        stack.push(p)
    assert [stack.pop() for _ in pairs] == pairs[::-1]


def test_no_rows(spark):
    assert repaired(rows_of(spark, [(1, 1, "user", "x")]).limit(0)) == []


def test_one_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = conversations.repair(conversations.damaged(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
