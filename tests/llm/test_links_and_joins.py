import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hirelake.llm import common, forest, jaccard, links, linededup, nndescent, queries


def grams(text, width=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def groups_of(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def check_join(docs):
    rows = docs.select("doc_id", "text").collect()
    sets = [grams(r.text) for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
              and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    root = groups_of(len(rows), linked)
    want = []
    for i, r in enumerate(rows):
        ids = [rows[k].doc_id for k in range(len(rows)) if root[k] == root[i] and rows[k].doc_id is not None]
        want.append((str(r.doc_id), str(min(ids) if ids else None), sum(i in p for p in linked)))
    got = jaccard.join(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == sorted(want)
    assert sum(r.kept for r in got) == len(set(root))
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_join_equals_brute_force(awkward, clashing, smoke_docs):
    check_join(awkward)
    check_join(clashing)
    check_join(smoke_docs)


def test_join_of_large_groups(spark):
    # 300 near copies of one text, 200 exact copies, and a passage in all
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[:i % 390] + [f"x{i}"] + base[i % 390 + 1:])) for i in range(300)]
    rows += [(1000 + i, " ".join(base[:100] + ["other"] * 400)) for i in range(200)]
    rows += [(2000 + i, " ".join(base[:100] + [f"y{i}z{k}" for k in range(300)])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in jaccard.join(docs).collect()}
    assert {got[i].class_id for i in range(300)} == {0}
    assert all(got[i].n_links == 299 for i in range(300))
    assert {(got[1000 + i].class_id, got[1000 + i].n_links) for i in range(200)} == {(1000, 199)}
    assert all((got[2000 + i].class_id, got[2000 + i].n_links) == (2000 + i, 0) for i in range(150))


def test_join_of_nothing(nothing):
    assert jaccard.join(nothing).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 105), (105, 103), (7, 7)]
    scratch = common.Scratch(spark, "test")
    got = common.components(scratch, spark.createDataFrame(edges, "a long, b long"), "c").collect()
    assert {r.node: r.component for r in got} == {**dict.fromkeys(range(31), 0), 100: 100, 103: 100, 105: 100}


def test_labels():
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 2), (2, 3), (3, 1), (4, 5)):
        linked[a, b] = linked[b, a] = True
    assert links.labels(linked).tolist() == [0, 0, 0, 0, 4, 4]


def test_rounds_meet_each_pair_once_within_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(links, "LEAST_BYTES", 0)
    blocks = [1, 2, 3, 8, 41]
    rows = [(g, 1000 * g + k, k % n, n, 5) for g, n in enumerate(blocks) for k in range(2 * n)]
    members = spark.createDataFrame(rows, "component int, node long, own int, blocks int, bytes long")
    ends, met, most = links._rounds({n: 10 * n for n in blocks}), Counter(), []
    for low, high in zip([0, *ends], ends):
        held = {}
        for r in links.blocked(members, low, high).collect():
            held.setdefault((r.component, r.first, r.second), []).append((r.node, r.own))
        most.append(sum(map(len, held.values())))
        for (_, first, second), some in held.items():
            met.update((a, b) for a, x in some for b, y in some if a < b and (first == second or x != y))
    assert met == Counter((a, b) for g, a, *_ in rows for h, b, *_ in rows if g == h and a < b)
    assert len(most) > 5 and max(most) <= links.REPEATS * len(rows)


def test_rounds_give_the_same_links(spark, monkeypatch):
    text = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(text[:i % 57] + [f"new{i}"] + text[i % 57 + 1:])) for i in range(120)] + [(500 + i, f"own {i} " * 9) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    at_once = sorted(map(tuple, jaccard.join(docs).collect()))
    monkeypatch.setattr(links, "LEAST_BYTES", 0)
    assert sorted(map(tuple, jaccard.join(docs, block=9).collect())) == at_once
    assert max(r[2] for r in at_once) > 0


def embeddings(spark, extra=()):
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((12, 16))
    x = [centres[i % 12] + 0.1 * draw.standard_normal(16) for i in range(120)] + list(draw.standard_normal((500, 16)))
    rows = [(i, [float(v) for v in y]) for i, y in enumerate(x)] + [(900 + i, rows_) for i, rows_ in enumerate(extra)]
    return rows


ODD = [None, [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0], [2.0, 4.1], []]


def brute_links(rows):
    linked = []
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and len(a) == len(b) and None not in a and None not in b:
                x, y = np.array(a), np.array(b)
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                    if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.9:
                        linked.append((i, j))
    return linked


def test_forest_equals_brute_force(spark):
    rows = embeddings(spark, ODD)
    rows += [(5000 + i, rows[0][1]) for i in range(40)] + [(None, rows[1][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("x")).repartition(3)
    linked = brute_links(rows)
    root = groups_of(len(rows), linked)
    want = []
    for i, (v, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == root[i] and rows[k][0] is not None]
        want.append((str(v), sum(i in p for p in linked), str(min(ids) if ids else None)))
    got = forest.near_duplicates(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == sorted(want)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_forest_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.near_duplicates(none).collect() == []
    assert nndescent.nearest(none, F.lit(True)).collect() == []


def test_nearest_equals_brute_force(spark):
    rows = embeddings(spark, ODD)
    rows += [(5000 + i, rows[20][1]) for i in range(40)] + [(None, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("code", F.lit("x")).repartition(3)
    got = nndescent.nearest(df, F.col("vec_id") % 20 == 0).collect()
    sound = [(v, np.array(x)) for v, x in rows if v is not None and x and len(x) == 16 and None not in x and np.isfinite(x).all() and any(x)]
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = r
    hits = 0
    queries_ = [(v, x) for v, x in sound if v % 20 == 0]
    assert set(found) == {v for v, _ in queries_}
    vectors = dict(sound)
    for q, x in queries_:
        best = sorted((-float((x * y).sum()), v) for v, y in sound if v != q)[:20]
        mine = [found[q][k] for k in range(1, 21)]
        assert all(abs(r.score - float((x * vectors[r.vec_id]).sum())) < 1e-9 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({v for _, v in best} & {r.vec_id for r in mine})
    assert hits >= 0.9 * 20 * len(queries_)


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nndescent.nearest(df, F.col("vec_id") == 20).collect()]
    assert sorted(got) == [(20, 1, 1, 1.0), (20, 2, 2, 0.0)]


def test_lines_awkward(awkward, clashing, nothing):
    for docs in (awkward, clashing):
        got = linededup.drop_recurring(docs)
        assert got.columns[:len(docs.columns)] == docs.columns and got.count() == docs.count()
        rows = {r.doc_id: r for r in got.collect()}
        assert not rows[30].n_dropped and rows[31].n_dropped == 1 and rows[31].emptied and rows[32].cleaned_text == ""
        assert rows[20].cleaned_text == "" and rows[20].n_lines == 1 and rows[22].cleaned_text == " \n\t "
        assert not rows[40].n_dropped and not rows[41].n_dropped  # neither line recurs
    assert linededup.drop_recurring(nothing).collect() == []


def test_lines_one_varied_quarter(spark):
    words = [f"w{chr(97 + i)}" for i in range(24)]
    texts = {1: words, 2: words, 3: words[:20] + ["new", "words"] + words[22:], 4: words[:3] + ["x", "y"] + words[5:20] + ["z"] + words[21:]}
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in linededup.drop_recurring(docs).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_lines_variable_fields(spark):
    line = "posted on {} by user{} in the forum about ships and other things of the sea"
    docs = spark.createDataFrame([(i, f"own text {i} stays\n" + line.format(f"2020-01-0{i}", i)) for i in range(1, 5)]
                                 + [(9, "of the and\nof the and")], "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.drop_recurring(docs).collect()}
    assert [got[i].n_dropped for i in (1, 2, 3, 4, 9)] == [0, 1, 1, 1, 0]
    assert got[2].cleaned_text == "own text 2 stays"


def test_lines_no_literal_repeat_needed(spark):
    """Short menu lines, and templates whose variable field holds a word, several of them in one leaf."""
    words = ["anna", "bert", "cora", "dora", "emil", "fred", "gina", "hugo", "ines", "jan"]
    rows = []
    for i, w in enumerate(words):
        rows.append((i, "\n".join([
            "Home", "About us", f"my own text {w}",
            f"article by the editor {w} smith published in the daily news",           # 10 tokens, one variable quarter
            f"we use cookies on this site {w} please read the notice on cookies",     # 12 tokens, and the next in the same leaf
            f"we use cookies on other sites as well see {w} for the list"])))
    got = {r.doc_id: r for r in linededup.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_dropped == 0 and not got[0].emptied
    for i, w in enumerate(words[1:], 1):
        assert (got[i].n_lines, got[i].n_dropped, got[i].emptied, got[i].cleaned_text) == (6, 5, True, f"my own text {w}")
    few = spark.createDataFrame([r for r in rows if r[0] < 2], "doc_id long, text string")
    assert all(not r.n_dropped for r in linededup.drop_recurring(few).collect())


def test_lines_masks_equal_brute_force(spark):
    """Lines of 8 to 12 tokens, their leaf the same, with quarters from small sets."""
    draw = random.Random(4)
    texts = {}
    for i in range(60):
        texts[i] = ["a b c " + " ".join(f"{draw.choice('pqrs' if k % 2 else 'vwxyz')}{'x' * (k // 2)}" for k in range(draw.choice([5, 5, 9]))) for _ in range(4)]

    def masks(line):
        t = line.split(" ")
        q = [tuple(t[len(t) * i // 4:len(t) * (i + 1) // 4]) for i in range(4)]
        return [(len(t), i, *q[:i], *q[i + 1:]) for i in range(4)]

    own, held = {}, {}
    for i, ls in texts.items():
        for x in ls:
            own.setdefault(x, set()).add(i)
            for m in masks(x):
                held.setdefault(m, {}).setdefault(i, set()).add(x)
    taken = {x for x, ids in own.items() if len(ids) > 1}
    first = {m: min(i for i, xs in ids.items() if any(x not in taken or min(own[x]) == i for x in xs)) for m, ids in held.items()}
    want = {}
    for i, ls in texts.items():
        some = [[m for m in masks(x) if len(held[m]) > 2] for x in ls]
        gone = [i != min(own[x]) if x in taken else bool(ms) and all(first[m] != i for m in ms) for x, ms in zip(ls, some, strict=True)]
        want[i] = (sum(gone), all(gone), "\n".join(x for x, g in zip(ls, gone, strict=True) if not g))
    assert 20 < sum(w[0] for w in want.values()) < 230
    docs = spark.createDataFrame([(i, "\n".join(ls)) for i, ls in texts.items()], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_dropped, r.emptied, r.cleaned_text) for r in linededup.drop_recurring(docs).collect()}
    assert got == want


def test_registered(smoke_docs):
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
