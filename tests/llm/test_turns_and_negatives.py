import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelake.llm import common, hardneg, queries, turns

SMOKE = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string"


# ---------------------------------------------------------- turns, brute force
def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else "".join(c for c in text if c not in ".!?") if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        left = text.strip(SPACE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(rows, faulty):
    """All edits tried: (cost, audit, texts) of the least cost, then the least audit."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if role[0] in after[last]:
                    c, a, t = best(i, role[0], inserted + 1)
                    options.append((c + 5, "I" + a, (f"{role}:", *t)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, t = best(i + 1, last, 0)
            options.append((c + 2, "D" + a, t))
            if faulty[i] not in ("blank", "duplicate"):
                more = 5 * (faulty[i] == "truncated")
                for letter, cost, to in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if to[:1] and to[0] in after[last]:
                        c, a, t = best(i + 1, to[0], 0)
                        options.append((c + cost + more, letter + a, (f"{to}:{text}", *t)))
        return min(options, default=(1 << 30, "", ()))

    return best(0, "", 0)


def expected(rows, given):
    by = {conv: [] for conv, *_ in given}
    for row in rows:
        by[row[0]].append(row)
    for conv, own in by.items():
        own.sort(key=order)
        faulty = faults(own)
        known = [t for _, t, _, _ in own if t is not None]
        cost, audit, texts = repaired(tuple(own), tuple(faulty))
        initials = [r[2][:1] for r in own]
        yield (conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faulty.count(x) for x in ("blank", "duplicate", "truncated")),
               sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
               hashlib.sha256("\n".join(texts).encode()).hexdigest())


def some_turns(n, seed):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", "", None])
            text = draw.choice(["Yes.", "No!", "cut off", " \n", "", None, "é ?", "ends. \t", f"own {turn}."])
            rows.append((conv, draw.choice([turn, turn, turn, 2 * turn, None]), role, text))
    rows += [(None, 0, "user", "Without a number."), (None, 1, "assistant", "Yes.")]
    return rows + rows[5:8]  # rows repeated


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0]))


@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_repair_equals_all_edits_tried(spark, chunk):
    rows = [(c, t, r or " ", " " if x is None else x) for c, t, r, x in some_turns(150, 1)]
    found = turns.Repair(spark.createDataFrame(rows, TURNS).repartition(3), chunk=chunk)
    columns = ["conv_id", *turns.COUNTS, "audit", "repaired_sha256"]
    want = sorted(expected(rows, rows), key=lambda r: (r[0] is not None, r[0]))
    assert result(found.summary().select(*columns)) == want
    by = {}
    for r in found.turns().orderBy("conv_id", "position").collect():
        assert r.position == len(by.setdefault(r.conv_id, []))
        by[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, *_, digest in want:
        assert hashlib.sha256("\n".join(by.get(conv, [])).encode()).hexdigest() == digest


def test_query_equals_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = sorted(expected(damaged(given), given), key=lambda r: r[0])
    df = queries.op12_turn_repair(spark, SMOKE)
    assert df.columns == ["conv_id", *turns.COUNTS, "audit", "repaired_sha256"]
    assert result(df) == want


def test_nulls_dropped_conversations_and_a_long_one(spark):
    long = [(9, t, "user" if t % 2 == 0 else "assistant", f"Turn {t} " + "x" * (t % 50) + ".") for t in range(30_000)]
    given = some_turns(60, 2) + [(7_000_000 + i, 0, "user", "Alone.") for i in range(60)] + long
    frame = spark.createDataFrame(given, TURNS).repartition(5).withColumn("key", F.lit("clash")).withColumn("kind", F.lit(None).cast("int"))
    got = {r[0]: r for r in result(turns.report(frame, turns.damage(frame)))}
    short = [r for r in given if r[0] != 9]
    for row in expected(damaged(short), short):
        if row[0] != 9:
            assert got.pop(row[0]) == row
    row = got.pop(9)
    assert not got and len(row[7]) > 25_000 and row[1] > 0
    assert turns.report(frame.limit(0), turns.damage(frame.limit(0))).count() == 0


def test_a_very_long_text_passes_whole(spark):
    text = "word " * 600_000 + "end."
    rows = [(1, 0, "user", text), (1, 1, "assistant", "Yes.")]
    (row,) = result(turns.Repair(spark.createDataFrame(rows, TURNS)).summary())
    assert row[7] == "KK" and row[8] == hashlib.sha256(f"user:{text}\nassistant:Yes.".encode()).hexdigest()


# ------------------------------------------------------ hard negatives, brute force
def negatives(rows, modulus=100):
    """rows: (vec_id, label, whole numbers)"""
    rows = sorted(rows)
    width = max((len(v) for *_, v in rows), default=0)
    whole = np.array([list(v) + [0] * (width - len(v)) for *_, v in rows], dtype=object).reshape(len(rows), width)
    out = []
    for a, (anchor, label, _) in enumerate(rows):
        if anchor % modulus:
            continue
        score = whole @ whole[a] if width else np.zeros(len(rows), int)
        ranked = sorted((-max(min(int(s), hardneg.MOST), hardneg.LEAST), r[0], r[1]) for s, r in zip(score, rows) if r[0] != anchor)
        for s, positive, _ in [x for x in ranked if x[2] == label][:5]:
            inside = [x for x in ranked if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(anchor, positive, k, x[1], -s, -x[0]) for k, x in enumerate(inside[:5], 1)]
    return sorted(out)


def usable(table):
    out = {}
    for vec_id, label, vector in table:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        key = (label, [float(x) for x in vector])
        out[vec_id] = min(out.get(vec_id, key), key)
    return [(i, label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in out.items()]


VECTORS = "vec_id long, label int, embedding array<float>"


def test_negatives_of_the_query(spark):
    table = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
             for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    df = queries.op13_hard_negatives(spark, "/root/testdata/sf0.01")
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert result_all(df) == negatives(usable(table)) != []


def result_all(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def some_vectors(n, seed, scale=1.0, width=24):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, width))
    rows = []
    for i in range(n):
        label = int(draw.integers(0, 5))
        v = centres[i % 4] + 0.4 * draw.normal(size=width)
        v = v[: int(draw.integers(3, width + 1))] if i % 11 == 0 else v
        rows.append((i, label, [float(x) for x in np.float32(v * scale)]))
    rows += [(n + i, 1, rows[0][2]) for i in range(40)]  # one vector many times: ties
    rows += [(n + 50, None, rows[1][2]), (n + 51, 1, None), (n + 52, 1, [1.0, None]), (n + 53, 2, [float("nan")]), (None, 1, rows[3][2]),
             (n + 54, 2, [float("inf"), 1.0]), (n + 55, 2, []), rows[7], rows[7], (8, 4, rows[9][2]), (n + 56, 77, rows[2][2])]
    return rows


@pytest.mark.parametrize(("scale", "cells"), [(0.2, 1 << 18), (1.0, 600), (3e5, 2000), (1e25, 1 << 18)])
def test_negatives_equal_brute_force(spark, monkeypatch, scale, cells):
    monkeypatch.setattr(hardneg, "INDEX_CELLS", cells)
    monkeypatch.setattr(hardneg, "ANCHOR_CELLS", cells // 4)
    rows = some_vectors(400, 3, scale)
    frame = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("rows", F.lit(1)).withColumn("lane", F.lit("x"))
    assert result_all(hardneg.mine(frame, F.col("vec_id") % 10 == 0)) == negatives(usable(rows), 10) != []


def test_anchors_are_never_broadcast_to_the_lanes(spark, monkeypatch):
    """Spark knows the size of the anchors' file, not that each lane gets them all."""
    plans = []

    class Recorded(common.Scratch):
        def write(self, df, name):
            if name in ("positives-0", "negatives-0"):
                plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().write(df, name)

    monkeypatch.setattr(hardneg.common, "Scratch", Recorded)
    monkeypatch.setattr(hardneg, "INDEX_CELLS", 40)
    monkeypatch.setattr(hardneg, "LANE_BLOCKS", 2)
    rows = some_vectors(400, 3, 0.2)
    assert result_all(hardneg.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0)) == negatives(usable(rows), 10)
    assert len(plans) == 2 and all("SortMergeJoin [lane" in p and "Broadcast" not in p for p in plans)


def test_few_rows_and_none(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [0.5, 0.0]), (10, 3, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, VECTORS)
    assert result_all(hardneg.mine(frame, F.col("vec_id") % 10 == 0)) == negatives(usable(rows), 10)
    assert hardneg.mine(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hardneg.mine(frame.where("vec_id = 10"), F.col("vec_id") % 10 == 0).count() == 0
    labels = {r.vec_id: r.label for r in hardneg.relabelled(spark.createDataFrame([(7, 9, []), (8, 9, []), (14, None, [])], VECTORS)).collect()}
    assert labels == {7: 0, 8: 9, 14: None}
