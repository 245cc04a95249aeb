import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from hirelake.llm import pii, queries

SMOKE = "/root/testdata/sf0.001"
# the contract's own patterns
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def right(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if right(kind, m[0])]
    return sorted(found)


def digest(text):
    found = base(text)
    kinds = list(PATTERNS)
    joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in found)
    return (*(sum(k == n for _, k, _ in found) for n in range(4)), hashlib.sha256(joined.encode()).hexdigest(), joined)


def noise(seed, n):
    draw = random.Random(seed)
    parts = ["@", ".", "-", "+", " ", "1", "23", "255", "256", "a", "b.c", "x_y", "%", "(", ")", "4111 1111 1111 1111", "10.0.0.1",
             "+1 (017) 555-7713", "und.34@mail7.example.com", "é", "😀", "\n", "00", "4111-1111-1111-1112", "@b.c", "a@b", "+12 34", "\x00", "  "]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def check(found, texts):
    for i, text in texts.items():
        row, want = found[i], digest(text)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256) == want[:5], (text, want[5], row.spans)
        assert set(filter(None, want[5].split(","))) <= set(filter(None, row.spans.split(",")))
        at = [(int(s), list(PATTERNS).index(k)) for k, s, _ in (x.split(":") for x in row.spans.split(",") if x)]
        assert at == sorted(at)


def test_rules_equal_the_contract_on_noise(spark):
    texts = dict(enumerate([None, "", *noise(1, 3000)]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    check(rows_of(pii.digest(pii.find(df))), texts)


def test_query_equals_the_contract(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    df = queries.op11_boosted_pii(spark, SMOKE)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    found = rows_of(df)
    assert len(found) == len(texts)
    check(found, texts)


def corpus(n, seed):
    """Texts with all kinds in them, and numbers that are none."""
    draw = random.Random(seed)

    def card():
        digits = "4" + "".join(draw.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    def wrong():
        value = card()
        return value[:-1] + str((int(value[-1]) + draw.randint(1, 9)) % 10)

    made = [lambda: f"mail {draw.choice('abcd')}{draw.randint(1, 99)}@mail{draw.randint(1, 9)}.example.com today", card,
            lambda: f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}", lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4)),
            wrong, lambda: f"order {draw.randint(10**6, 10**8)}", lambda: f"we sat at home. {draw.choice(['Then', 'Later'])} we left"]
    return [" ".join(["some words"] + [draw.choice(made)() + " of the" for _ in range(4)]) for _ in range(n)]


@pytest.fixture(scope="module")
def learnt(spark):
    texts = corpus(800, 4)
    extra = {5000: "write to jane.doe (at) mail3 (dot) example (dot) com please",
             5001: "pay 4111111111111111 5500005555555559 now",       # two cards in one run of digits
             5002: "phone (917) 555-1234 in the evening",
             5003: "we sat at home. Then we left at noon. Nothing else",
             5004: "orders 1234567 and 87654321 of 2024-01-02",
             5005: "not a card: 4111111111111112",
             5006: "Größe 😀 jane@mail.example.com and 😀 4111 1111 1111 1111"}
    rows = [*enumerate(texts), *extra.items()]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), {**dict(enumerate(texts)), **extra}


def test_trees_add_what_rules_miss_and_leave_the_rest(spark, learnt):
    df, texts = learnt
    found = rows_of(pii.digest(pii.find(df)))
    check(found, texts)
    got = {i: [(k, texts[i][int(s):int(e)]) for k, s, e in (x.split(":") for x in found[i].spans.split(",") if x)] for i in texts if i >= 5000}
    assert got[5000] == [("email", "jane.doe (at) mail3 (dot) example (dot) com")]
    assert got[5001] == [("card", "4111111111111111"), ("card", "5500005555555559")]
    assert got[5002] == [("phone", "(917) 555-1234")]
    assert got[5003] == got[5004] == got[5005] == []
    assert got[5006] == [("email", "jane@mail.example.com"), ("card", "4111 1111 1111 1111")]
    clean = [i for i in range(800) if not base(texts[i])]
    assert sum(bool(found[i].spans) for i in clean) <= 0.05 * len(clean)


def test_trees_tell_held_out_rows_apart(spark, learnt):
    df, _ = learnt
    cells = pii.labelled(pii.candidates(df, ["doc_id"])).groupBy("f", "held").agg(
        F.count_if("right").alias("yes"), F.count_if(~F.col("right")).alias("no")).collect()
    model = pii.fit(pii.candidates(df, ["doc_id"]))
    good = total = 0
    for r in cells:
        if r.held:
            chosen = pii._chance(model.margin(tuple(r.f))) >= 0.5
            good, total = good + (r.yes if chosen else r.no), total + r.yes + r.no
    assert total > 300 and good / total > 0.95
    assert {pii.KINDS[k] for k in model.thresholds} == {"email", "card", "phone"}


def test_scores_in_spark_equal_the_trees(spark, learnt):
    df, _ = learnt
    found = pii.candidates(df, ["doc_id"])
    model = pii.fit(found)
    rows = pii.labelled(found).select("f", model.column(F.col("f")).alias("score")).distinct().collect()
    assert rows and all(abs(r.score - pii._chance(model.margin(tuple(r.f)))) < 1e-9 for r in rows)


def test_selection_equals_brute_force(spark):
    draw = random.Random(8)
    model = pii.Model(thresholds={0: 0.2, 2: 0.4, 3: 0.3})
    model.trees = [(1, k, -0.5, 0.3) for k in range(0, 20, 3)] + [(0, 2, 0.1, -0.2)]
    docs, want = [], {}
    zero = [0] * len(pii.FEATURES)
    for doc in range(60):
        ruled = sorted({(s, draw.randint(0, 3), s + draw.randint(3, 12), draw.random() < 0.7) for s in draw.sample(range(0, 400, 17), 4)})
        more = [(s, k, s + draw.randint(5, 20), draw.randint(0, 20)) for k in (0, 2, 3) for s in range(draw.randint(0, 9), 400, 23)]
        docs.append((doc, [(k, s, e, "", "", "", ok) for s, k, e, ok in ruled], [(k, s, e, (k, d, *zero[2:])) for s, k, e, d in more]))
        scored = [(s, k, e, False, pii._chance(model.margin((k, d, *zero[2:])))) for s, k, e, d in more]
        every = sorted({(s, k, e, True, 1.0) for s, k, e, ok in ruled if ok} | {x for x in scored if x[4] >= model.thresholds.get(x[1], 2)})
        rank = lambda x: (x[4], x[2] - x[0], -x[0], -x[1])
        want[doc] = [x[:4] for x in every if x[3] or not any(
            y[0] < x[2] and x[0] < y[2] and (y[3] or rank(y) > rank(x)) for y in every if y != x)]
    f = ",".join(f"{c}:int" for c in pii.FEATURES)
    df = spark.createDataFrame(docs, "doc_id long, base array<struct<kind:int,start:long,end:long,value:string,left:string,right:string,ok:boolean>>,"
                               f"more array<struct<kind:int,start:long,end:long,f:struct<{f}>>>")
    for r in df.select("doc_id", pii._selected(model).alias("spans")).collect():
        assert [tuple(x)[:4] for x in r.spans] == want[r.doc_id]


def test_awkward_rows(spark, awkward, clashing, nothing):
    texts = {r.doc_id: r.text for r in awkward.collect()}
    check(rows_of(pii.digest(pii.find(clashing, keep=["doc_id", "score", "row"])).drop("row")), texts)
    assert pii.digest(pii.find(awkward)).count() == awkward.count()
    assert pii.find(nothing).count() == 0


LONG = {1: "a" * 2_000_000, 2: "1" * 1_000_000, 3: "ab.c-" * 300_000, 4: "x@y" * 200_000, 5: "1." * 20_000, 6: "+1" + " " * 1_000_000,
        7: "1 " * 400_000, 8: "jane@mail.example.com 10.0.0.1, 4111111111111111, +1 (017) 555-7713 " * 400, 9: "a@b" + ".c" * 300_000,
        10: "4111-" * 200_000, 11: "(1) " * 200_000, 12: "word at " * 100_000}


def test_long_texts_and_hot_runs(spark):
    df = spark.createDataFrame(list(LONG.items()), "doc_id long, text string").repartition(4)
    found = rows_of(pii.digest(pii.find(df)))
    assert found[8].n_email == found[8].n_ip == found[8].n_card == found[8].n_phone == 400
    assert found[5].n_ip == 5_000
    for i in (5, 8, 9):
        assert found[i].base_sha256 == digest(LONG[i])[4]
    assert found[1].spans == found[2].spans == found[3].spans == ""


def test_the_model_learns_from_all_counts(spark):
    """More counts than come to the driver are fitted as well, not a part of them."""
    draw = random.Random(7)
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    texts = [f"{draw.choice(['call', 'pay by card', 'see', 'host'])} +{number(2)} {number(3)} {number(6)} or {number(16)}, "
             f"mail a{number(2)}@b{number(1)}.com, {number(4)}-{number(4)}-{number(4)}-{number(4)} at {number(9)}" for _ in range(400)]
    found = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id"]).cache()
    seen = [tuple(r.f) for r in pii.labelled(found).select("f").distinct().collect()]
    whole, spread = pii.fit(found), pii.fit(found, cells=20)
    assert len(seen) > 20 and whole.thresholds
    assert spread.thresholds == pytest.approx(whole.thresholds, abs=1e-4)
    assert [spread.margin(f) for f in seen] == pytest.approx([whole.margin(f) for f in seen], abs=1e-4)
    found.unpersist()
