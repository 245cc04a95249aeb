import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import common, katz, licences, mixing, pack, queries, toxicity

SMOKE = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[j - 1] + 1, row[j - 1] + (x != y)))
    return out


def test_automaton_equals_brute_force():
    lexicon = ["abcd", "bacad", "dabbac", "abcabcabca", "cab*", "é"]
    automaton = toxicity.Automaton(lexicon)
    draw = random.Random(3)
    some = ["".join(draw.choice("abcdxé") for _ in range(draw.randint(1, 13))) for _ in range(4000)] + ["abcd", "cab", "cabxxxxxxxxxxxxxxxxx", "é"]
    term, cost = automaton.match(pa.array(some))
    for w, t, c in zip(some, term, cost, strict=True):
        near = [(0 if w.startswith(x[:-1]) else 99) if x.endswith("*") else edits(w, x) for x in lexicon]
        near = [n for n, x in zip(near, lexicon, strict=True) if n <= toxicity.tolerance(x)]
        assert (t >= 0) == bool(near) and (not near or c == min(near)), w


def test_quotation_counts_less():
    automaton = toxicity.Automaton(["stupid"])
    plain, quoted, direct = (toxicity.hits(automaton, pa.array([x]))[5][0] for x in
                             ("he is stupid today", 'he said " stupid " today', "you are stupid today"))
    assert quoted < plain < direct


def test_toxicity_learns_and_scores(spark, awkward, clashing, nothing):
    draw = random.Random(5)
    clean = ["alpha", "beta", "gamma", "delta", "house", "river", "stone", "cloud"]
    docs, labels = [], []
    for i in range(400):
        text = [draw.choice(clean) + draw.choice("abc") for _ in range(60)]
        if i % 5 == 0:
            text[10], text[30] = draw.choice(["horrid", "vilest"]), "horrid" if i % 10 else "vilest"
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    labels += [(None, 1), (7777, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(model.lexicon) == {"horrid", "vilest"}
    got = {r.row.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in range(400))
    for odd in (awkward, clashing):
        scored = toxicity.score(odd, model)
        assert scored.select("row.*").columns == odd.columns
        assert all(0 <= r.score < 0.7 and not r.hits for r in scored.collect())
    assert toxicity.score(nothing, model).collect() == []
    none = toxicity.fit(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(frame, none).collect()} == {0.0}


def test_toxicity_held_out(spark):
    got = queries.QUERIES["op5_lexicon_toxicity"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8  # some labelled texts hold no mark at all
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.95


def brute_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(found)


def test_licences_equal_brute_force(spark, awkward, clashing, nothing):
    texts = ["cc by cc by CC-BY 4.0", "GNU General Public License, version 3. all rights, reserved; All RIGHTS reserved", "cc", "",
             None, "xcc by", "cc  by\n\ngeneral\tpublic. license", "// SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Apache-2.0 \nmore"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for frame in (docs, awkward, clashing):
        rows = {r.doc_id: r for r in licences.summary(licences.scan(frame)).collect()}
        for d in frame.select("doc_id", "text").collect():
            if d.doc_id is None:
                continue
            n, found = brute_places(d.text)
            r = rows[d.doc_id]
            assert (r.n_words, r.n_base) == (n, len(found))
            assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
            assert r.base_labels == ",".join(sorted({x for _, x in found})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
            assert 0 <= r.score <= 1
    got = {r.doc_id: r for r in licences.summary(licences.scan(docs)).collect()}
    assert got[7].labels == "apache-2.0,gpl-3.0-only,mit" and got[7].score == pytest.approx(0.15)
    assert licences.summary(licences.scan(nothing)).collect() == []


def test_each_licence_tag_has_its_own_expression(spark):
    texts = ["SPDX-License-Identifier: MIT */ text /* SPDX-License-Identifier: GPL-3.0-only", "xSPDX-License-Identifier: agpl-3.0\nSPDX-License-Identifier: (MIT)",
             "SPDX-License-Identifier:\nmit", "SPDX license\nidentifier SPDX-License-Identifier: MIT or SPDX-License-Identifier: isc é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(x.label, x.word, x.restrictiveness) for x in r.found] for r in licences.scan(docs).collect()}
    r = licences.restrictiveness
    assert got == {0: [("mit", 0, r("mit")), ("gpl-3.0-only", 5, r("gpl-3.0-only"))], 1: [("mit", 6, r("mit"))], 2: [],
                   3: [("mit", 3, r("mit")), ("isc", 8, r("isc"))]}


def test_shunting_yard():
    def value(text):
        return licences.evaluate(licences.expression_tokens(text))[1]

    r = licences.restrictiveness
    assert value("mit or gpl-3.0 and agpl-3.0") == r("mit")
    assert value("(mit or gpl-3.0) and agpl-3.0") == r("agpl-3.0")
    assert value("gpl-2.0 with classpath-exception-2.0 and mit") == pytest.approx(0.75 * r("gpl-2.0"))
    assert licences.evaluate(licences.expression_tokens("mit and (apache-2.0 or"))[0] == {"mit", "apache-2.0"}
    assert licences.expression_tokens("mit */ int main") == ["mit"]
    assert licences.postfix(["a", "or", "b", "and", "c"]) == ["a", "b", "c", "and", "or"]


def test_periods_are_pfair():
    draw = random.Random(2)
    for _ in range(30):
        weights = {f"s{i}": draw.random() + 0.01 for i in range(draw.randint(1, 8))}
        quota = mixing.quotas(weights, 200)
        assert sum(quota.values()) == 200 and min(quota.values()) >= 1
        slots = mixing.period(quota)
        assert sorted(x for v in slots.values() for x in v) == list(range(200))
        for k, q in quota.items():
            done = 0
            for slot in range(200):
                done += slot in slots[k]
                assert abs(done - (slot + 1) * q / 200) < 1


def test_phases_place_every_block_once():
    blocks = {"a": 70, "b": 5, "c": 31}
    plan = mixing.phases({"a": 5.0, "b": 3.0, "c": 2.0}, blocks, 10)
    taken = []
    for p in plan:
        for nth in range(p["end_block"] - p["first_block"]):
            taken.append(p["first_slot"] + nth // len(p["slots"]) * p["size"] + p["slots"][nth % len(p["slots"])])
    assert sorted(taken) == list(range(106))


def test_mix(awkward, clashing, nothing):
    for docs in (awkward, clashing):
        got = mixing.mix(docs, {"src0": 3.0, "src1": 1.0}, block=500)
        assert got.count() == docs.count() and got.select("row.*").columns == docs.columns
        first = {}
        for r in got.collect():
            assert r["class"] == (r.row.source if r.row.source in ("src0", "src1") else "others")
            assert first.setdefault(r.slot, (r["class"], r.block)) == (r["class"], r.block)
    assert mixing.mix(nothing, {"src0": 1.0}).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(nothing, {"src0": 0.0})


def katz_brute(docs):
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [" end"]

    one, two, frame = Counter(), Counter(), Counter()
    for d, held in docs:
        if not held:
            t = tokens(d.text)
            one.update(t)
            two.update(zip([" start"] + t, t, strict=False))
            frame.update([" start"] + t[:-1])
    n, v = sum(one.values()), len(one)
    tables = [katz.discounts([sum(c == r for c in x.values()) for r in range(1, katz.K + 2)]) for x in (one, two)]
    star = [lambda c, t=t: float(katz.starred(np.array([c]), t)[0]) for t in tables]
    p1 = {w: star[0](c) / n for w, c in one.items()}
    unseen = 1 - sum(p1.values())
    taken, shadowed = Counter(), Counter()
    for (a, w), c in two.items():
        taken[a] += star[1](c) / frame[a]
        shadowed[a] += p1[w]
    alpha = {a: (1 - taken[a]) / (1 - shadowed[a]) for a in frame}
    for a in list(frame)[:20]:  # each context's probabilities add up to one
        total = sum(star[1](two[a, w]) / frame[a] if two[a, w] else alpha[a] * p1[w] for w in one) + alpha[a] * unseen
        assert total == pytest.approx(1)
    out = []
    for d, held in docs:
        t = tokens(d.text)
        score = sum(math.log10(star[1](two[a, w]) / frame[a] if two[a, w] else alpha.get(a, 1.0) * p1.get(w, unseen))
                    for a, w in zip([" start"] + t, t, strict=False))
        out.append((str(d.doc_id), held, len(t), sum(one[w] > 0 for w in t), n,
                    sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t), score))
    return out


def test_katz_equals_brute_force(awkward, clashing, smoke_docs, monkeypatch):
    for docs in (awkward, clashing, smoke_docs):
        held = common.in_fold("doc_id", 7, 2)
        rows = docs.select("doc_id", "text", held.alias("held")).collect()
        want = sorted(katz_brute([(r, r.held) for r in rows]))
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                     for r in katz.score(docs, held).collect())
        for a, b in zip(got, want, strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_katz_without_training(awkward, nothing):
    got = katz.score(awkward, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in got} == {(0, 0, 0.0)}
    assert katz.score(nothing, F.lit(False)).collect() == []


def test_pipeline(spark, awkward):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMOKE)
        assert after.columns == first.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in docs.select("doc_id").collect()}
        docs = after.cache()
    assert docs.count() > 0.5 * first.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_keeps_documents_with_short_lines(spark):
    shared = "all rights to this long line of boilerplate are shared by two"
    verse = [f"line {chr(97 + i)} of verse" for i in range(20)]
    rows = [(1, shared), (2, "\n".join([shared, *verse])), (3, shared + "\n \n\t"), (4, ""), (5, shared + "\nown words")]
    docs = spark.createDataFrame([(*r, "en", "src0", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert kept == {1: shared, 2: "\n".join(verse), 4: "", 5: "own words"}


def test_packed_sequences_follow_the_weights(spark, monkeypatch):
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choice("aeiklmnorst") for _ in range(6)) for _ in range(40)) for _ in range(400)]
    rows = [(i, text, "en", f"src{i % 2}", 1) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    def packed(weights, others):
        return pack.pack(docs, length=64, weights=mixing.shares(weights, others), block=400, window=20)

    def early(weights):
        """The first source's share of tokens in the first windows' sequences."""
        got = packed(weights, 1e-9).collect()
        first = [r for r in got if r.sequence_id * 64 < 0.3 * sum(r.length for r in got)]
        return sum(r.length for r in first if r.doc_id % 2 == 0) / sum(r.length for r in first)

    assert early({"src0": 1.0, "src1": 3.0}) == pytest.approx(0.25, abs=0.08)
    assert early({"src0": 3.0, "src1": 1.0}) == pytest.approx(0.75, abs=0.08)
    pieces = packed({"src0": 1.0}, 1.0).collect()
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    assert sorted(r.sequence_id * 64 + r.offset for r in pieces) == sorted(
        sum(r.length for r in pieces if (r.sequence_id, r.offset) < (s.sequence_id, s.offset)) for s in pieces)

    def shift(weights):
        monkeypatch.setattr(corpus_pipeline, "TARGETS", weights)
        monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
        monkeypatch.setattr(common, "table", lambda *_: docs)
        monkeypatch.setattr(pack.pack, "__defaults__", (None, 64, 2, None, 400, 20))
        return {(r.doc_id, r.start, r.sequence_id, r.offset) for r in corpus_pipeline.run(spark, "").collect()}

    assert shift({"src0": 1.0, "src1": 3.0}) != shift({"src0": 3.0, "src1": 1.0})
