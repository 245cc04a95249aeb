"""Repeatable loads, increments, schema from the data, page chains, title model."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from hirelake.functions.columns import LAST_7, MONTH_COL, month_of
from hirelake.operators import fact as fact_ops
from hirelake.operators import marts, pages, partials, title_model, titles
from hirelake.operators import skills as skill_ops
from hirelake.plans import increment, loads, pipeline
from hirelake.plans.pipeline import Inputs, build_all
from hirelake.sources import adapters as ad
from hirelake.sources import sinks
from hirelake.sources.batches import BatchTable


def folder(name):
    return tempfile.mkdtemp(prefix=f"hirelake-{name}-")


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect()))


def rounded(df):
    return rows(df.select(*(F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes if t != "timestamp_ntz" or c != "date_time")))


# ------------------------------------------------------------ batch tables
KEYED = "k string, month string, v int"


@pytest.fixture
def table(spark):
    return BatchTable(spark, folder("batches"), ["month"])


def test_a_batch_is_loaded_once(spark, table):
    first = spark.createDataFrame([("a", "m1", 1), ("b", "m2", 2), (None, None, 3)], KEYED)
    assert table.read() is None and table.rows() == 0
    assert table.append("one", first)
    assert not table.append("one", first.union(first))
    assert rows(table.read()) == rows(first) and table.rows() == 3 and table.batches() == ["one"]


def test_keys_are_merged_over_batches_and_within_one(spark, table):
    table.append("one", spark.createDataFrame([("a", "m1", 1), ("b", "m2", 2), (None, None, 3)], KEYED), key="k")
    again = [("a", "m1", 9), ("c", "m1", 5), ("c", "m1", 4), (None, None, 7), ("d", None, 8)]
    assert table.append("two", spark.createDataFrame(again, KEYED), key="k", order=F.col("v"))
    assert rows(table.read(["two"]).select("k", "v")) == [("c", "4"), ("d", "8")]
    assert table.append("three", spark.createDataFrame(again, KEYED), key="k") and table.read(["three"]).count() == 0
    assert table.rows() == 5


def test_rows_are_ordered_only_where_a_key_repeats(spark):
    table = BatchTable(spark, folder("ordered"))
    batch = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    never = F.raise_error(F.lit("ordered")).cast("int")
    assert table.append("one", batch, key="k", order=never) and table.append("again", batch, key="k", order=never)
    twice = spark.createDataFrame([("c", 2), ("c", 1), (None, 0), (None, 9), ("d", 4)], "k string, v int")
    assert table.append("two", twice, key="k", order=F.col("v"))
    assert rows(table.read()) == rows(batch.unionByName(spark.createDataFrame([("c", 1), ("d", 4)], "k string, v int")))


def test_the_probe_reads_the_batch_s_partitions_only(spark, table):
    table.append("one", spark.createDataFrame([("a", "m1", 1), ("b", "m2", 2)], KEYED), key="k")
    plan = table._unseen(spark.createDataFrame([("a", "m1", 1)], KEYED), "k", None)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "(month#" in plan and "= m1)" in plan
    assert "ReadSchema: struct<k:string>" in plan


def test_a_killed_load_leaves_nothing_and_can_be_run_again(spark, table, monkeypatch):
    data = spark.createDataFrame([("a", "m1", 1)], KEYED)
    commit = BatchTable._commit

    def killed(self, entry):
        raise KeyboardInterrupt

    monkeypatch.setattr(BatchTable, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        table.append("one", data)
    monkeypatch.setattr(BatchTable, "_commit", commit)
    assert len(os.listdir(f"{table.path}/data")) == 1 and table.read() is None
    assert table.append("one", data) and table.read().count() == 1


def test_one_of_two_attempts_commits(spark, table):
    data = spark.createDataFrame([("a", "m1", 1)], KEYED)
    table.append("one", data)
    entry = {**table.entries()[0], "folder": "other"}
    assert not table._commit(entry)
    assert table.entries()[0]["folder"] != "other" and table.read().count() == 1
    assert [n for n in os.listdir(f"{table.path}/manifest") if n.startswith(".one-") and not n.endswith(".crc")] == []


def test_a_batch_takes_the_place_of_others(spark, table):
    for name, v in (("one", 1), ("two", 2)):
        table.append(name, spark.createDataFrame([(name, "m1", v)], KEYED))
    table.append("right", spark.createDataFrame([("one", "m1", 7)], KEYED), replaces=["one"])
    assert rows(table.read().select("k", "v")) == [("one", "7"), ("two", "2")]
    assert not table.append("one", spark.createDataFrame([("one", "m1", 1)], KEYED))
    table.compact("all", table.read())
    assert table.batches() == ["all"] and rows(table.read().select("k", "v")) == [("one", "7"), ("two", "2")]


def test_a_column_of_a_later_batch(spark):
    table = BatchTable(spark, folder("wider"))
    table.append("one", spark.createDataFrame([("a",)], "k string"))
    table.append("two", spark.createDataFrame([("b", 2)], "k string, v int"))
    assert rows(table.read()) == [("a", "None"), ("b", "2")]


# -------------------------------------------------------- the daily build
@pytest.fixture(scope="module")
def inputs(spark):
    created = F.get_json_object("results", "$.search_metadata.created_at")
    smoke = "/root/testdata/sf0.001"
    stored = folder("inputs")
    # the last months: a folder per month and table takes its time
    pages = ad.raw_pages(spark, smoke).where(created >= "2001-03-01")
    typed = ad.typed_postings(spark, smoke).where("date_time >= '2000-12-01'")
    made = {"pages": pages, "typed": typed, "country": ad.country_dim(spark, smoke), "skill_dim": ad.brand_skills(spark, smoke)}
    for name, df in made.items():
        sinks.write_table(df, f"{stored}/{name}")
    return Inputs(**{name: spark.read.parquet(f"{stored}/{name}") for name in made})


@pytest.fixture(scope="module")
def whole(spark, inputs):
    out = folder("whole")
    return out, build_all(spark, inputs, out, ad.AS_OF)


def _tables(spark, out):
    found = {n: spark.read.parquet(f"{out}/{n}") for n in ("fact", "salary", "skills", "titles", "wide", "public")}
    for n in ("archive", "landing"):
        found[n] = BatchTable(spark, f"{out}/{n}", [MONTH_COL]).read().drop("results", "date_time", MONTH_COL)
    return {n: rows(df) for n, df in found.items()}


def test_build_twice_equals_once(spark, inputs, whole):
    out = folder("twice")
    build_all(spark, inputs, out, ad.AS_OF, batch="day")
    build_all(spark, inputs, out, ad.AS_OF, batch="day")
    build_all(spark, inputs, out, ad.AS_OF)  # the same pages under another name
    assert _tables(spark, out) == _tables(spark, whole[0])


def test_build_after_a_kill_equals_one_run(spark, inputs, whole, monkeypatch):
    out = folder("killed")
    build = fact_ops.build_fact

    def killed(*args, **kw):
        raise KeyboardInterrupt

    monkeypatch.setattr(pipeline.fact_ops, "build_fact", killed)  # after the archive, ahead of the fact
    with pytest.raises(KeyboardInterrupt):
        build_all(spark, inputs, out, ad.AS_OF, batch="day")
    monkeypatch.setattr(pipeline.fact_ops, "build_fact", build)
    assert BatchTable(spark, f"{out}/archive", [MONTH_COL]).rows() > 0
    build_all(spark, inputs, out, ad.AS_OF, batch="day")
    assert _tables(spark, out) == _tables(spark, whole[0])


def _days(inputs):
    late = F.coalesce(F.get_json_object("results", "$.search_metadata.created_at") >= "2001-06-01", F.lit(False))
    return (Inputs(inputs.pages.where(part), inputs.typed, inputs.country, skill_dim=inputs.skill_dim) for part in (~late, late))


@pytest.fixture(scope="module")
def two_days(spark, inputs):
    out = folder("days")
    tables = increment.Increments(spark, out)
    first, second = _days(inputs)
    tables.add("day-1", first)
    tables.add("day-2", second)
    return tables


def _same_marts(got, result):
    assert got["skills"].count() > 20 and got["grains"].count() > 50
    for name in ("skills", "slicer", "skill_trend", "num_jobs", "dates", "last_update", "public"):
        assert rounded(got[name]) == rounded(result[name]), name
    frames = {"All time": "alltime", "Last 7 days": "7day", "Last 30 days": "30day", "YTD": "ytd"}
    for name, mart in frames.items():
        assert rounded(got["grains"].where(F.col("timeframe") == name).drop("timeframe")) == rounded(result[mart]), name


def test_two_days_equal_a_full_build(spark, whole, two_days):
    fact = two_days.fact.read().drop(MONTH_COL)
    assert rows(fact) == rows(spark.read.parquet(f"{whole[0]}/fact").drop(MONTH_COL))
    _same_marts(two_days.marts(ad.AS_OF), whole[1])


def test_days_loaded_again_change_nothing(spark, inputs, whole, two_days):
    before = {n: t.entries() for n, t in (("fact", two_days.fact), ("wide", two_days.wide), *two_days.partials.items())}
    for day, part in zip(("day-1", "day-2"), _days(inputs), strict=True):
        two_days.add(day, part)
    assert before == {n: t.entries() for n, t in (("fact", two_days.fact), ("wide", two_days.wide), *two_days.partials.items())}


@pytest.mark.parametrize("step", ["fact", "partials"])
def test_an_increment_killed_anywhere(spark, inputs, whole, monkeypatch, step):
    tables = increment.Increments(spark, folder(f"killed-{step}"))
    victim = {"fact": tables.fact, "partials": tables.partials["sizes"]}[step]
    append = victim.append

    def killed(*args, **kw):
        raise KeyboardInterrupt

    monkeypatch.setattr(victim, "append", killed)
    with pytest.raises(KeyboardInterrupt):
        tables.add("day", inputs)
    monkeypatch.setattr(victim, "append", append)
    tables.add("day", inputs)
    got = tables.marts(ad.AS_OF)
    for name in ("skills", "num_jobs", "dates"):
        assert rounded(got[name]) == rounded(whole[1][name]), name


def test_an_earlier_page_moves_the_cut_off(spark, inputs, whole):
    """The later pages first: the typed rows counted with them go when older pages come."""
    tables = increment.Increments(spark, folder("moved"))
    first, second = _days(inputs)
    tables.add("day-2", second)
    assert tables.fact.rows() > 0
    tables.add("day-1", first)
    assert rows(tables.fact.read().drop(MONTH_COL)) == rows(spark.read.parquet(f"{whole[0]}/fact").drop(MONTH_COL))
    assert len([b for b in tables.fact.batches() if b.startswith("typed-")]) == 1
    _same_marts(tables.marts(ad.AS_OF), whole[1])


def test_a_day_reads_its_own_pages_only(spark, two_days):
    entry = next(e for e in two_days.archive.entries() if e["batch"] == "day-2")
    files = two_days.archive.read(["day-2"]).inputFiles()
    assert files and all(entry["folder"] in f for f in files)
    assert len(two_days.archive.read().inputFiles()) > len(files)


def test_marts_of_a_timeframe_read_its_months(spark, two_days):
    week = partials.since(two_days.partials["skills"].read(), LAST_7, ad.AS_OF)
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(search_month" in plan and "2001-07-01" in plan


def test_survivors_of_a_prefix_read_its_partition(spark, two_days):
    from hirelake.operators import public
    stored = two_days.partials["public"].read()
    few = public.keys_of(stored, ["0a", "ff"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_prefix" in plan and "IN (0a,ff)" in plan
    assert stored.where("key_prefix <> lower(left(hex(_key), 2))").count() == 0


def test_compaction_keeps_the_marts(spark, inputs, whole):
    tables = increment.Increments(spark, folder("compact"))
    for day, part in zip(("day-1", "day-2"), _days(inputs), strict=True):
        tables.add(day, part)
    parts = tables.partials["sizes"].rows()
    tables.compact("all")
    assert tables.partials["sizes"].batches() == ["all"] and tables.partials["sizes"].rows() <= parts
    _same_marts(tables.marts(ad.AS_OF), whole[1])
    tables.compact("all")
    assert tables.partials["sizes"].batches() == ["all"]


# ----------------------------------------------------- mergeable medians
def test_merged_medians_are_within_the_rank_bound(spark):
    """Skewed pays over many days, each day a sketch of its own."""
    draw = random.Random(2)
    data = [(i, f"2001-{1 + i % 7:02d}-{1 + i % 28:02d}", float(round(draw.lognormvariate(11, 0.6))), ["hot"] + (["rare"] if i % 50 == 0 else []))
            for i in range(40_000)]
    wide = (spark.createDataFrame(data, "job_id long, day string, salary_year double, keywords_all array<string>")
            .withColumn("search_time", F.col("day").cast("timestamp_ntz")).withColumn("job_title_final", F.lit("t")).withColumn("search_country", F.lit("c")))
    part = partials.pay_partials(wide)
    found = partials.skill_pay(partials.merged(part), ad.AS_OF)
    ranked = partials.rank_of(wide, found, ad.AS_OF).collect()
    assert {r.skill for r in ranked} == {"hot", "rare"} and part.count() >= 42
    for r in ranked:
        slack = 2 * partials.RANK_ERROR + 1 / r["count"]
        assert r.below <= 0.5 + slack and r.upto >= 0.5 - slack, r
    exact = {r.skill: r for r in marts.skill_pay(wide).collect()}
    for r in ranked:
        if r.timeframe == "All time":
            e = exact[r.skill]
            assert (r["count"], r["min"], r["max"]) == (e["count"], e["min"], e["max"]) and abs(r.avg - e.avg) < 1e-6
            assert abs(r.median - e.median) < 0.05 * e.median


# ------------------------------------------------------------ page chains
def chains(given):
    """Brute force: follow each page to the one ahead until a start or a ring."""
    nodes = {(s, t) for s, t, _ in given}
    ahead = {}
    for s, t, n in given:
        if n is not None and n != t:
            ahead.setdefault((s, n), []).append(t)
    up = {k: min(v, key=lambda t: (t is not None, t or "")) for k, v in ahead.items()}
    own = {(s, t) for s, t, n in given if n is not None and n == t}
    out = []
    for s, t, n in given:
        at, place, seen = t, 0, set()
        while at is not None and (s, at) in up and at not in seen:
            seen.add(at)
            at, place = up[s, at], place + 1
        ring = at is not None and ((s, at) in up or (s, at) in own)
        state = "cycle" if ring else "whole" if at is None else "broken"
        if n is None:
            next_is = "none"
        elif (s, n) not in nodes:
            next_is = "missing"
        else:
            next_is = "follows" if (s, n) in up and up[s, n] == t else "elsewhere"
        out.append((s, t, n, place if state == "whole" else None, None if ring else at, None if ring else place, state, next_is))
    return out


def test_chains_equal_brute_force(spark):
    draw = random.Random(6)
    given = []
    for search in range(120):
        n = draw.choice([1, 2, 3, 5, 9, 17, 40])
        own = [None] + [f"t{i}" for i in range(1, n)]
        links = [own[i + 1] if i + 1 < n else None for i in range(n)]
        kind = draw.randint(0, 5)
        if kind == 1 and n > 2:      # the last one names an earlier page
            links[-1] = own[draw.randint(1, n - 1)]
        if kind == 2:                # some were never landed
            keep = [i for i in range(n) if draw.random() < 0.8]
            own, links = [own[i] for i in keep], [links[i] for i in keep]
        if kind == 3 and n > 3:      # the first is gone and the rest is a ring
            own, links = own[1:], links[1:-1] + [own[1]]
        if kind == 4 and n > 3:      # two name the same page
            links[draw.randint(0, n - 2)] = own[n - 1]
        given += list(zip([search if search else None] * len(own), own, links, strict=True))
    given += [(500, "x", "x"), (501, None, "gone"), (502, "a", None)]
    df = spark.createDataFrame(given, "search long, token string, next_token string").repartition(3)
    found = pages.page_chains(df)
    assert found.columns == ["search", "token", "next_token", "result_offset", "chain_start", "place", "state", "next_is"]
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(chains(given), key=key)
    assert pages.page_chains(df.limit(0)).count() == 0


def test_a_chain_of_thousands_of_pages(spark):
    n = 3000
    df = spark.range(n).select(F.lit("s").alias("search"), F.when(F.col("id") > 0, F.col("id").cast("string")).alias("token"),
                               F.when(F.col("id") < n - 1, (F.col("id") + 1).cast("string")).alias("next_token"))
    found = pages.page_chains(df)
    assert found.where("state = 'whole' AND result_offset = coalesce(cast(token AS bigint), 0)").count() == n


# ----------------------------------------------- schema from the data, K9
def test_fields_that_change_are_rescued(spark):
    jobs = [{"job_id": "1", "title": "a", "via": "x", "detected_extensions": {"salary": "9", "bonus": 3}},
            {"job_id": "2", "title": {"text": "b"}, "via": "y", "stars": 4.5, "detected_extensions": {"work_from_home": True, "via": "hidden"}},
            {"job_id": "3", "via": None, "extensions": ["p", "q"]}]
    page = json.dumps({"jobs_results": jobs})
    given = spark.createDataFrame([("t", "l", 0, False, page), ("t", "l", 1, True, page), ("t", "l", 2, False, '{"jobs_results": []}'),
                                   ("t", "l", 3, False, "{broken")], "search_term string, search_location string, result_offset long, error boolean, results string")
    archive = fact_ops.archive_rows(given)
    profile = {r.field: (r.n_postings, r.type) for r in pages.field_profile(pages.posting_fields(archive)).collect()}
    assert profile["title"] == (2, "VARIANT") and profile["stars"][0] == 1 and profile["job_id"] == (3, "STRING")
    assert profile["work_from_home"] == (1, "BOOLEAN") and "detected_extensions" not in profile
    found = pages.landing_by_data(archive).orderBy("job_id").collect()
    assert [r.title for r in found] == ["a", None, None] and [r.via for r in found] == ["x", "y", None]
    assert [r.work_from_home for r in found] == [None, True, None] and found[2].extensions == ["p", "q"]
    assert [json.loads(r.rescued) if r.rescued else None for r in found] == [{"bonus": 3}, {"title": {"text": "b"}, "stars": 4.5}, None]
    assert "commute_time" not in found[0].asDict() and "thumbnail" not in found[0].asDict()
    assert pages.landing_by_data(archive.limit(0)).count() == 0


def test_routed_rows_add_up(spark):
    df = spark.createDataFrame([(1, "ok"), (2, None), (3, "bad"), (4, "bad"), (None, "ok")], "id int, v string")
    path = sinks.scratch_path(spark, "routed-test")
    seen = sinks.routed(df, path, {"no value": F.col("v").isNull(), "bad value": F.col("v") == "bad", "no id": F.col("id").isNull()})
    assert (seen["rows"], seen["accepted"], seen["rejected"], seen["reason bad value"]) == (5, 1, 4, 2)
    good, bad = (sinks.read_routed(spark, path, side, df.schema) for side in (sinks.ACCEPTED, sinks.REJECTED))
    assert rows(good) == [("1", "None", "ok")] and rows(bad.groupBy("reason").count()) == [("1", "no id"), ("1", "no value"), ("2", "bad value")]
    none = sinks.scratch_path(spark, "routed-test")
    sinks.routed(df.where("id = 1"), none, {"no id": F.col("id").isNull()})
    assert sinks.read_routed(spark, none, sinks.REJECTED, df.schema).count() == 0


# ------------------------------------------------------------ title model
def test_the_model_beats_word_overlap_on_titles_held_out(spark):
    """Titles whose words tell the label without being in it."""
    draw = random.Random(9)
    words = {"Data Engineer": ["etl", "pipelines", "airflow", "warehouse", "engineer"], "Data Analyst": ["reports", "dashboards", "insight", "analyst"],
             "Software Engineer": ["backend", "java", "developer", "services"]}
    both = []
    for label, own in words.items():
        for _ in range(250):
            both.append((" ".join(draw.sample(own, 2) + [draw.choice(["senior", "remote", "team", "data"])]), label))
    df = spark.createDataFrame(both, "job_title string, job_title_clean string").distinct()
    held = F.pmod(F.xxhash64("job_title"), F.lit(3)) == 0
    labels = list(words)
    model = title_model.fit(df.where(~held), labels, folder("model"))
    accuracy = title_model.agreement(title_model.score(df.where(held), model), df.where(held)).first()
    overlap = title_model.agreement(titles.classify_titles(df.where(held), labels=labels), df.where(held)).first()
    assert accuracy.titles > 40 and accuracy.accuracy > 0.95 > overlap.accuracy
    again = title_model.TitleModel.load(spark, _path_of(model))
    assert rows(title_model.score(df, again)) == rows(title_model.score(df, model))


def _path_of(model):
    return os.path.dirname(os.path.dirname(model.words.inputFiles()[0])).removeprefix("file://").removeprefix("file:")


def test_titles_without_known_words_and_empty_training(spark):
    df = spark.createDataFrame([("data engineer", "Data Engineer"), ("report writer", "Data Analyst"), (None, "Data Analyst"), ("x", None)],
                               "job_title string, job_title_clean string")
    model = title_model.fit(df, ["Data Analyst", "Data Engineer", "Unused"], folder("model"))
    new = spark.createDataFrame([("Sr. Data Engr",), ("zzz",), (None,), ("",), ("report",), ("report",)], "job_title string")
    found = {r.job_title: r.job_title_clean for r in title_model.score(new, model).collect()}
    assert found == {"Sr. Data Engr": "Data Engineer", "report": "Data Analyst"}
    none = title_model.fit(df.limit(0), ["Data Analyst"], folder("model"))
    assert title_model.score(new, none).count() == 0


def test_headlines_held_out(spark):
    labelled, every = loads.headline_titles(spark, "/root/testdata/sf0.01")
    held = F.pmod(F.xxhash64("job_title"), F.lit(4)) == 0
    model = title_model.fit(labelled.where(~held), loads.LANGUAGES, folder("model"))
    got = title_model.agreement(title_model.score(labelled.where(held), model), labelled.where(held)).first()
    assert got.titles > 50 and got.accuracy > 0.9


# --------------------------------------- running sums, table dictionary
def test_running_sums_and_places_equal_a_window(spark):
    from pyspark.sql import Window

    from hirelake.operators import numbering
    draw = random.Random(3)
    data = [(draw.randint(0, 40), draw.choice("abc"), draw.randint(-5, 90)) for _ in range(700)]
    df = spark.createDataFrame(data, "k int, c string, v int").distinct().repartition(5)
    order = ["k", "c", "v"]
    ahead = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.coalesce(F.sum("v").over(ahead), F.lit(0)).alias("s"), F.row_number().over(Window.orderBy(*order)).alias("n"))
    assert rows(numbering.sum_before(df, order, "v", "s", partitions=7)) == rows(want.drop("n"))
    assert rows(numbering.number_rows(df, order, "n", partitions=7)) == rows(want.drop("s"))
    assert numbering.sum_before(df.limit(0), order, "v", "s").count() == 0


def test_a_table_dictionary_tags_as_literals_do(spark):
    from hirelake.functions.keywords import SKILL_CATEGORIES
    from hirelake.operators import skills
    words = [k for ks in SKILL_CATEGORIES.values() for k in ks]
    draw = random.Random(5)
    docs = [(i, " ".join(draw.choice([*words, "the", "and,", "(of)", "Sql.", "--"]) for _ in range(draw.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame([*docs, (999, None), (1000, "")], "id int, text string").repartition(3)
    tagged = skills.tag_keywords(df, "text", keep=["id"], all_column=None)
    table = skills.tag_by_table(df, "text", skills.dictionary_frame(spark), key="id")
    assert rows(table.drop("place")) == rows(skills.skill_pairs(tagged, "id", list(SKILL_CATEGORIES)))
    lengths = {r.words: r.keywords for r in skills.dictionary_lengths(skills.dictionary_frame(spark)).collect()}
    assert max(lengths) <= 3 and sum(lengths.values()) == len({w.lower() for w in words})


def test_categories_multiply_a_text_s_keywords_behind_its_places(spark):
    """A keyword of several categories (one of them NULL) is placed once a text, then multiplied."""
    dictionary = spark.createDataFrame([("x", "Big"), ("y", "big"), (None, "big"), ("x", "big data"), ("x", "no such thing at all")], "category string, keyword string")
    docs = spark.createDataFrame([(1, "The big big data."), (1, "big"), (None, "data big"), (2, None)], "id long, text string")
    out = skill_ops.tag_by_table(docs, "text", dictionary, key="id")
    big = [(k, c, "big", p) for k, p in ((1, 1), (None, 2)) for c in ("x", "y", None)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([*big, (1, "x", "big data", 3)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(") < plan.index("Aggregate [")


def test_only_runs_of_the_dictionary_leave_a_text(spark, monkeypatch):
    """What is written and joined grows with the keywords found, not with the tokens; keys repeat and are NULL."""
    paths, draw = {}, random.Random(8)
    plain = skill_ops.sinks.scratch_path
    monkeypatch.setattr(skill_ops.sinks, "scratch_path", lambda s, name: paths.setdefault(name, plain(s, name)))
    keywords = [" ".join(f"k{draw.randint(0, 9)}" for _ in range(n)) for n in (2, 2, 3, 4, 4, 5) for _ in range(4)] + ["k1", "K2", "k1  k2"]
    texts = [" ".join(draw.choice([f"k{draw.randint(0, 9)}", f"noise{draw.randint(0, 10**6)},"]) for _ in range(700)) for _ in range(24)]
    keys = [None if i % 6 == 0 else i % 15 for i in range(24)]
    want = {}
    for key, text in zip(keys, texts):
        tok = [w.strip(",") for w in text.split()]
        for kw in {k.lower() for k in keywords if len(k.split(" ")) <= 4}:
            n = len(kw.split(" "))
            places = [i + 1 for i in range(len(tok) - n + 1) if " ".join(tok[i:i + n]) == kw]
            if places:
                want[key, kw] = min(places[0], want.get((key, kw), 10**9))
    docs = spark.createDataFrame([*zip(keys, texts), (77, None)], "id int, text string").repartition(3)
    dictionary = spark.createDataFrame([("c", k) for k in keywords], "category string, keyword string")
    out = skill_ops.tag_by_table(docs, "text", dictionary, key="id", max_words=4)
    assert {(r.id, r.keyword): r.place for r in out.collect()} == want and out.count() == len(want)
    assert spark.read.parquet(paths["keyword-runs"]).count() < 24 * len(keywords) + 24 * 700 * 4 // 20
    assert skill_ops.tag_by_table(docs, "text", dictionary.limit(0), key="id").count() == 0
