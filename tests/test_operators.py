"""Operator edge cases (FIXTURES.md section 4) on hand-written frames."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from hirelake.functions.columns import ALL_TIME, LAST_7
from hirelake.operators import fact as fact_ops
from hirelake.operators import geo, incremental, marts, public, salary, skills, titles, wide
from hirelake.operators.dedup import dedup_by_key
from hirelake.operators.numbering import number_by_key
from hirelake.sources import sinks


# ----------------------------------------------------------------- salary
SALARY_CASES = [
    ("62K–65K a year", dict(salary_min=62000, salary_max=65000, salary_avg=63500, salary_year=63500, salary_hour=None)),
    ("20–30.5 an hour", dict(salary_avg=25.25, salary_hour=25.25, salary_year=None)),
    ("1,200 a month", dict(salary_avg=1200, salary_year=None, salary_hour=None)),
    ("$95.5K a year", dict(salary_avg=95500, salary_year=95500)),
    ("100–120K a year", dict(salary_min=100, salary_max=120000, salary_avg=60050)),
    ("62K-65K a year", dict(salary_avg=None, salary_min=None, salary_max=None)),
    ("Competitive", dict(salary_avg=None, salary_min=None, salary_year=None)),
]


def _salary(spark, compat=False):
    rows = [(str(i), t) for i, (t, _) in enumerate(SALARY_CASES)] + [("99", None)]
    df = spark.createDataFrame(rows, "job_id string, job_salary string")
    return {r.job_id: r.asDict() for r in salary.salary_dimension(df, compat=compat).collect()}


def test_salary_edge_values(spark):
    out = _salary(spark)
    assert "99" not in out                      # NULL text -> row dropped
    for i, (_, expect) in enumerate(SALARY_CASES):
        for k, v in expect.items():
            assert out[str(i)][k] == pytest.approx(v) if v is not None else out[str(i)][k] is None, (i, k)


def test_salary_dollar_compat(spark):
    out = _salary(spark, compat=True)
    assert out["3"]["salary_avg"] is None       # '$' left in place by the no-op regex
    assert out["3"]["salary_pay"].startswith("$")


def test_salary_dimension_one_row_per_key(spark):
    df = spark.createDataFrame([("a", "10 an hour"), ("a", "20 an hour"), ("b", None)],
                               "job_id string, job_salary string")
    out = salary.salary_dimension(df).collect()
    assert [(r.job_id, r.salary_hour) for r in out] == [("a", 10.0)]


# ----------------------------------------------------------------- tagger
def _tags(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    return skills.tag_keywords(df, "t", keep=["id"]).first().asDict()


def test_tagger_keeps_the_order_of_first_occurrence(spark):
    assert _tags(spark, "ruby on rails, then SQL, excel")["keywords_all"] == ["ruby", "ruby on rails", "sql", "excel"]
    assert _tags(spark, "excel, power bi and sql; excel")["keywords_all"] == ["excel", "power bi", "sql"]
    assert _tags(spark, "sql then Power BI")["keywords_all"] == ["sql", "power bi"]


def test_tagger_takes_long_punctuation_runs_in_linear_time(spark):
    df = spark.createDataFrame([(1, "sql")], "id int, t string")
    long = df.select("id", F.concat("t", F.lit(" a"), F.repeat(F.lit("-"), F.lit(1_000_000)), F.lit("x power bi")).alias("t"))
    skills.tag_keywords(df, "t", keep=["id"]).collect()
    begun = time.perf_counter()
    assert skills.tag_keywords(long, "t", keep=["id"]).first().keywords_all == ["sql", "power bi"]
    assert time.perf_counter() - begun < 5


def test_json_scalars_of_objects_and_arrays_are_null(spark):
    page = ('{"search_metadata": {"id": "s", "created_at": "2023-01-05 10:00:00 UTC", "total_time_taken": 1}, '
            '"search_parameters": {"hl": "en"}, "jobs_results": [{"job_id": "1", "title": {"a": 1}, "via": ["x"], '
            '"location": "[remote]", "description": 5, "company_name": null, '
            '"detected_extensions": {"salary": {"n": 1}, "posted_at": "{x"}}]}')
    pages = spark.createDataFrame([("t", "l", 0, False, page)], "search_term string, search_location string, "
                                  "result_offset bigint, error boolean, results string")
    r = fact_ops.json_postings(fact_ops.archive_rows(pages)).first()
    assert (r.job_id, r.job_title, r.job_via, r.job_location, r.job_description) == ("1", None, None, "[remote]", "5")
    assert (r.company_name, r.job_salary, r.job_posted_at) == (None, None, "{x")


def test_tagger_fixture_cases(spark):
    r = _tags(spark, "SQL, Python and SQL Server.")
    assert r["keywords_programming"] == ["sql", "python"]
    assert r["keywords_databases"] == ["sql server"]
    assert _tags(spark, "c/c++ only")["keywords_all"] is None
    assert _tags(spark, "we use c++")["keywords_programming"] == ["c++"]
    assert _tags(spark, "the .NET stack")["keywords_libraries"] == [".net"]
    assert _tags(spark, "the net stack")["keywords_libraries"] is None
    assert _tags(spark, "Power BI daily")["keywords_analyst_tools"] == ["power bi"]
    assert _tags(spark, "")["keywords_all"] is None
    assert _tags(spark, "gopher")["keywords_programming"] is None
    assert _tags(spark, "python python python")["keywords_programming"] == ["python"]
    r = _tags(spark, "SAS and ruby on rails")
    assert r["keywords_programming"] == ["sas", "ruby"] and r["keywords_analyst_tools"] == ["sas"]
    assert r["keywords_all"] == ["sas", "ruby", "ruby on rails"]          # distinct across categories
    assert _tags(spark, "OpenCV")["keywords_libraries"] == ["opencv"]       # mixed-case keyword


def test_tagger_overlapping_phrases(spark):
    cats = {"p": ["one of", "one of the", "of the"]}
    df = spark.createDataFrame([(1, "One of the best, one of")], "id int, t string")
    r = skills.tag_keywords(df, "t", keep=["id"], categories=cats, all_column=None).first()
    assert sorted(r.p) == ["of the", "one of", "one of the"]


def test_tagger_output_subset_of_dictionary(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    tagged = skills.tag_keywords(docs, "text", keep=["doc_id"], categories={"w": ["the", "of the", "and"]})
    found = {k for r in tagged.select(F.explode("keywords_all").alias("k")).distinct().collect() for k in [r.k]}
    assert found <= {"the", "of the", "and"}


def test_keyword_listing_skips_sync(spark):
    df = spark.createDataFrame([(1, "slack and python")], "id int, t string")
    listing = skills.keyword_listing(skills.tag_keywords(df, "t", keep=["id"]))
    rows = {(r.element, r.keyword) for r in listing.collect()}
    assert rows == {("python", "keywords_programming"), ("python", "keywords_all"), ("slack", "keywords_all")}


# ------------------------------------------------------------------- fact
def _page(jobs, **meta):
    page = {"search_metadata": {"id": "s1", "created_at": "2023-01-05 10:00:00 UTC", "total_time_taken": 1.5},
            "search_parameters": {"hl": "en"}}
    page.update(meta)
    if jobs is not None:
        page["jobs_results"] = jobs
    return json.dumps(page)


def _archive(spark, rows):
    df = spark.createDataFrame(rows, "search_term string, search_location string, result_offset bigint, "
                                     "error boolean, results string")
    return fact_ops.archive_rows(df)


def test_fact_json_edges(spark):
    hl = lambda t, i: {"title": t, "items": [i]}
    jobs = [
        {"job_id": "a", "job_highlights": [hl("Benefits", "b0"), hl("Qualifications", "q1"),
                                           hl("Qualifications", "q2"), hl("Responsibilities", "r3")],
         "related_links": [{"link": "https://www.google.com/x", "text": "See web results"},
                           {"link": "https://co", "text": "See web too"}],
         "extensions": ["No degree mentioned"], "detected_extensions": {"work_from_home": True}},
        {"job_id": "b", "related_links": [{"link": "https://co", "text": "Site"},
                                          {"link": "https://g", "text": "See web results"}],
         "extensions": ["Health insurance"]},
        {"job_id": "c"},
    ]
    rows = [("t", "l", 0, False, _page(jobs)), ("t", "l", 10, False, _page([])),
            ("t", "l", 20, False, _page(None)), ("t", "l", 30, True, _page(jobs)),
            ("t", "l", 40, None, _page(jobs)), ("t", "l", 50, False, "{not json")]
    out = fact_ops.json_postings(_archive(spark, rows)).collect()
    assert len(out) == 3 + 1 + 1 + 1          # empty, missing and malformed pages keep one NULL row
    by = {r.job_id: r for r in out}
    a, b, c = by["a"], by["b"], by["c"]
    assert a.job_highlights_qualifications == ["q1"]      # first matching block wins
    assert a.job_highlights_benefits == ["b0"]
    assert a.job_highlights_responsibilities is None      # position 3 is not looked at
    assert a.company_link is None and a.company_link_google == "https://www.google.com/x"
    assert b.company_link == "https://co" and b.company_link_google == "https://g"
    assert c.company_link is None and c.company_link_google is None and c.job_extensions is None
    assert a.job_work_from_home is True and b.job_work_from_home is None
    assert a.search_time == dt.datetime(2023, 1, 5, 10, 0)


def test_fact_flags_true_or_null(spark):
    rows = [("t", "l", 0, False, _page([{"job_id": "a", "extensions": ["No degree mentioned"]},
                                        {"job_id": "b", "extensions": ["x"]}]))]
    archive = _archive(spark, rows)
    typed = spark.createDataFrame([], "title string, company_name string, location string, via string, "
                                      "description string, extensions array<string>, job_id string, "
                                      "thumbnail string, posted_at string, schedule_type string, "
                                      "work_from_home boolean, salary string, search_term string, "
                                      "date_time timestamp_ntz, search_location string, commute_time string")
    out = {r.job_id: r for r in fact_ops.build_fact(archive, typed).collect()}
    assert out["a"].job_no_degree_mention is True and out["b"].job_no_degree_mention is None
    assert out["a"].job_health_insurance is None


def test_page_metadata_missing_field_nulls_all(spark):
    rows = [("t", "l", 0, False, json.dumps({"search_metadata": {"id": "x", "created_at": "2023-01-05 10:00:00 UTC",
                                                                  "total_time_taken": 2.0}}))]
    r = _archive(spark, rows).first()
    assert (r.search_id, r.search_time, r.search_time_taken, r.search_language) == (None, None, None, None)


def test_pre_cutoff_is_strict(spark):
    archive = _archive(spark, [("t", "l", 0, False, _page([]))])      # first page 2023-01-05 10:00
    ts = [dt.datetime(2023, 1, 5, 9, 59, 59, 999999), dt.datetime(2023, 1, 5, 10, 0), dt.datetime(2023, 1, 6)]
    typed = spark.createDataFrame([(str(i), t) for i, t in enumerate(ts)], "job_id string, date_time timestamp_ntz")
    for c in fact_ops.TYPED_RENAMES:
        if c not in typed.columns:
            typed = typed.withColumn(c, F.lit(None).cast("string"))
    assert [r.job_id for r in fact_ops.pre_cutoff(typed, archive).collect()] == ["0"]


def test_landing_rows_allow_list(spark):
    rows = [("t", "l", 0, False, _page([{"job_id": "a", "title": "x", "extra": 1,
                                        "detected_extensions": {"salary": "1 a year"}}])),
            ("t", "l", 0, True, _page([{"job_id": "e"}]))]
    out = fact_ops.landing_rows(_archive(spark, rows), load_time=F.lit(dt.datetime(2023, 1, 1)))
    assert set(out.columns) <= set(fact_ops.TYPED_ALLOW_LIST) and "extra" not in out.columns
    assert [(r.job_id, r.salary) for r in out.collect()] == [("a", "1 a year")]


# ---------------------------------------------------------- public / dedup
def test_public_via_and_flags(spark):
    rows = [("c", "t", None, "d", "l", dt.datetime(2023, 1, 1), "s1", "1", "T", "via LinkedIn", None, True, None, ["sql"]),
            ("c", "t", None, "d", "l", dt.datetime(2023, 1, 2), "s2", "2", "T", "via X", True, None, None, None),
            ("k", "t", None, "d", "l", None, None, "3", "T", "Olivia Jobs", None, None, None, None),
            ("m", "t", None, "d", "l", None, None, "4", "T", None, None, None, None, None)]
    schema = ("company_name string, job_title string, job_schedule_type string, job_description string, "
              "job_location string, search_time timestamp_ntz, search_id string, job_id string, "
              "job_title_final string, job_via string, job_work_from_home boolean, "
              "job_no_degree_mention boolean, job_health_insurance boolean, keywords_all array<string>")
    out = {r.company_name: r for r in public.public_table(spark.createDataFrame(rows, schema)).collect()}
    assert len(out) == 3                                        # NULL schedule type compares equal
    assert out["c"].job_posting_site == "LinkedIn" and out["c"].job_keywords == ["sql"]
    assert out["k"].job_posting_site == "OliJobs"
    assert out["m"].job_posting_site is None
    assert out["c"].job_work_from_home is False and out["c"].job_no_degree_mention is True


def test_dedup_is_idempotent_and_null_keys_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5), ("a", 5)], "k string, v int")
    once = dedup_by_key(df, ["k"], ["v"])
    assert sorted((r.k or "", r.v) for r in once.collect()) == [("", 1), ("a", 5)]
    assert sorted(map(tuple, dedup_by_key(once, ["k"], ["v"]).collect()), key=str) == \
        sorted(map(tuple, once.collect()), key=str)


# ------------------------------------------------------------ incremental
def test_anti_join_nulls(spark):
    src = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    dim = spark.createDataFrame([(1,)], "id int")
    dim_null = spark.createDataFrame([(1,), (None,)], "id int")
    assert [r.id for r in incremental.new_keys(src, dim, "id").collect()] == [2]
    assert [r.id for r in incremental.new_keys(src, dim_null, "id").collect()] == [2]
    assert incremental.new_keys(src, dim_null, "id", null_aware=True).count() == 0   # true NOT IN
    none = dim.limit(0)
    assert incremental.new_keys(src, none, "id", null_aware=True).count() == src.count()   # NULL keys stay


def test_enrich_new_twice_appends_nothing(spark, tmp_path):
    path = str(tmp_path / "dim")
    fact = spark.createDataFrame([("a", "python"), ("b", "sql")], "job_id string, job_description string")
    sinks.write_table(skills.skills_dimension(fact), path)
    more = fact.unionByName(spark.createDataFrame([("c", "java")], "job_id string, job_description string"))
    new = incremental.enrich_new(more, spark.read.parquet(path), "job_id", skills.skills_dimension)
    assert [r.job_id for r in new.collect()] == ["c"]
    sinks.append_rows(new, path)
    again = incremental.enrich_new(more, spark.read.parquet(path), "job_id", skills.skills_dimension)
    assert again.count() == 0


def test_unlabelled_reemits_null_label(spark):
    src = spark.createDataFrame([("x", 2), ("y", 1)], "job_title string, n int")
    dim = spark.createDataFrame([("x", None), ("z", "Z")], "job_title string, job_title_clean string")
    assert sorted(r.job_title for r in incremental.unlabelled(src, dim, "job_title", "job_title_clean").collect()) == ["x", "y"]


# ------------------------------------------------------------------ titles
def test_title_overlap_scorer(spark):
    df = spark.createDataFrame([("SR. DATA ENGINEER",), ("Data Engineer II",), ("Chef",), (None,)], "job_title string")
    out = {r.job_title: r.job_title_clean for r in titles.classify_titles(df).collect()}
    assert out == {"SR. DATA ENGINEER": "Senior Data Engineer", "Data Engineer II": "Data Engineer"}
    df2 = spark.createDataFrame([("Senior Data Engineer",), ("Sr. ML Engr",), ("SW Eng",)], "job_title string")
    out2 = {r.job_title: r.job_title_clean for r in titles.classify_titles(df2).collect()}
    assert out2 == {"Senior Data Engineer": "Senior Data Engineer",
                    "Sr. ML Engr": "Machine Learning Engineer", "SW Eng": "Software Engineer"}


def test_title_pluggable_scorer(spark):
    df = spark.createDataFrame([("a",), ("b",)], "job_title string")
    out = titles.classify_titles(df, scorer=lambda s, labels: s.map(lambda t: labels[0] if t == "a" else None))
    assert [(r.job_title, r.job_title_clean) for r in out.collect()] == [("a", "Data Engineer")]


# ------------------------------------------------------------- marts
def _wide(spark):
    rows = [("1", "A", "X", dt.datetime(2001, 8, 1), 100.0, ["s1", "s2"]),
            ("2", "A", None, dt.datetime(2001, 7, 25), None, ["s1"]),
            ("3", None, "X", dt.datetime(2001, 7, 24, 23, 59, 59, 999999), 50.0, ["s2"]),
            ("4", "B", "Y", None, None, None),
            ("1", "A", "X", dt.datetime(2001, 8, 1), 100.0, ["s1"])]
    return spark.createDataFrame(rows, "job_id string, job_title_final string, search_country string, "
                                       "search_time timestamp_ntz, salary_year double, keywords_all array<string>")


def test_timeframe_boundaries(spark):
    out = {(r.timeframe, r.skill): (r.skill_count, r.total_jobs)
           for r in marts.skills_by_timeframe(_wide(spark), "2001-08-01").collect()}
    assert out[(LAST_7, "s1")] == (3, 3)       # 07-25 00:00 is inside, 07-24 23:59:59.999999 is not
    assert (LAST_7, "s2") in out and out[(LAST_7, "s2")] == (1, 3)
    assert out[(ALL_TIME, "s2")] == (2, 5)     # total counts postings without skills and NULL times


def test_grains_drop_null_keys(spark):
    out = {(r.skill, r.job_title_final, r.search_country): (r.skill_count, r.total_jobs)
           for r in marts.skill_grains(_wide(spark)).collect()}
    assert out[("s1", "A", "X")] == (2, 2)
    assert ("s2", None, None) not in out
    assert out[("s2", None, "X")] == (2, 3)    # country grain: title NULL row counts
    assert all(not (t is None and c is None) for _, t, c in out)


def test_numbering_dense_and_compat(spark):
    w = _wide(spark)
    dense = {r.job_id: r.job_number for r in number_by_key(w, "job_id", "job_number", partitions=3).collect()}
    assert dense == {"1": 1, "2": 2, "3": 3, "4": 4}
    rows = number_by_key(w, "job_id", "job_number", distinct=False, partitions=3).collect()
    assert sorted(r.job_number for r in rows) == [1, 2, 3, 4, 5]
    assert sorted(r.job_number for r in rows if r.job_id == "1") == [1, 2]


def test_numbering_many_partitions(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("k"))
    out = number_by_key(df, "k", "n", partitions=7).orderBy("k").collect()
    assert [r.n for r in out] == list(range(1, 5001))


def test_rolling_window_rows_semantics(spark):
    days = [dt.datetime(2001, 1, d) for d in range(1, 21)]
    rows = [(str(i), "A", "X", d, None, ["s1"] if i % 2 == 0 else ["s2"]) for i, d in enumerate(days)]
    w = spark.createDataFrame(rows, _wide(spark).schema)
    out = marts.skill_trend(w, top_n=1).collect()       # s1: 10 rows on every other day
    assert {r.skill for r in out} == {"s1"}
    last = max(out, key=lambda r: r.date)
    assert last.skill_percentage == pytest.approx(10 / 14)   # 14 skill rows span 20 days; totals 14 days


def test_skill_pay(spark):
    out = {r.skill: r for r in marts.skill_pay(_wide(spark)).collect()}
    assert out["s1"]["count"] == 2 and out["s1"].avg == 100.0 and out["s1"].total_jobs == 3
    assert out["s2"].min == 50.0 and out["s2"].max == 100.0


# -------------------------------------------------------------- geo
def test_country_weights_sum_to_one(spark):
    views = spark.createDataFrame([("Total", 30, 30.0), ("US", 10, 10.0), ("DE", 10, 6.0), ("NA", 10, 2.0),
                                   ("FR", 0, 0.0)], "Geography string, Views long, `Watch time (hours)` double")
    codes = spark.createDataFrame([("DE", "Germany"), ("NA", "Namibia"), ("US", "United States")],
                                  "code string, country string")
    out = {r.country: r.percent for r in geo.country_weights(views, codes).collect()}
    assert out == {"Germany": 0.75, "Namibia": 0.25}


def test_weighted_order_prefers_heavy(spark):
    df = spark.createDataFrame([("heavy", 0.9), ("light", 0.1)], "c string, w double")
    firsts = sum(geo.weighted_order(df, "w", seed=s).where("draw_rank = 1").first().c == "heavy" for s in range(60))
    assert firsts > 42


def test_weighted_order_is_plan_independent(spark):
    df = spark.createDataFrame([(f"c{i}", 1.0 + i % 7) for i in range(200)], "c string, w double")
    a = {r.c: r.draw_rank for r in geo.weighted_order(df, "w", seed=7).collect()}
    b = {r.c: r.draw_rank for r in geo.weighted_order(df.repartition(5).orderBy(F.desc("c")), "w", seed=7).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 201))


def test_budget_cutoff(spark):
    df = spark.createDataFrame([(1, 600), (2, 600), (3, 600), (4, 600)], "k int, cost int")
    assert [r.k for r in geo.budget_cutoff(df, "k", "cost", 1500).collect()] == [1, 2, 3]


# ------------------------------------------------------------ sources/sinks
def test_csv_multiline_and_na(spark, tmp_path):
    p = tmp_path / "codes.csv"
    p.write_text('code,country,notes\nNA,Namibia,"line one\nline two"\nIR,"Iran ",x\n')
    df = sinks.read_csv(spark, str(p), "code string, country string, notes string")
    rows = df.collect()
    assert len(rows) == 2 and rows[0].code == "NA" and rows[0].notes == "line one\nline two"
    assert rows[1].country == "Iran "


def test_star_join_shapes(spark):
    fact = spark.createDataFrame([("1", "t1", "loc", "term", dt.datetime(2023, 1, 1)),
                                  (None, None, "other", "term2", None), (None, None, "other", "term2", None)],
                                 "job_id string, job_title string, search_location string, search_term string, "
                                 "search_time timestamp_ntz")
    sk = spark.createDataFrame([("1", "d", ["sql"])], "job_id string, job_description string, keywords_all array<string>")
    co = spark.createDataFrame([("other", "C")], "search_location string, search_country string")
    sa = spark.createDataFrame([("1", 10.0)], "job_id string, salary_avg double")
    ti = spark.createDataFrame([("t2", "T")], "job_title string, job_title_clean string")
    w = wide.build_wide(fact, sk, co, sa, ti)
    nulls = w.where("job_id IS NULL").collect()
    assert len(nulls) == 2 and all(n.salary_avg is None and n.keywords_all is None for n in nulls)
    assert all(n.search_country == "C" for n in nulls)          # non-key joins still apply
    r = w.where("job_id = '1'").first()
    assert w.columns[:3] == ["job_title_final", "job_title_clean", "job_id"]
    assert r.job_title_final == "term" and r.search_country is None and r.keywords_all == ["sql"]
    assert "job_description" not in w.columns


def test_audit_report_and_export(spark, tmp_path):
    from hirelake.plans.pipeline import export_marts
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "k int, arr array<string>")
    observed, obs = sinks.audited(df)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 2
    assert sinks.report(df) == {"rows": 2, "schema": "struct<k:int,arr:array<string>>"}
    export_marts({"m": df}, str(tmp_path))
    back = sinks.read_csv(spark, str(tmp_path / "m"), "k int, arr string").orderBy("k").collect()
    assert [(r.k, r.arr) for r in back] == [(1, "a|b"), (2, None)]


def test_top5_ties_break_by_skill(spark):
    rows = [(str(i), "A", "X", dt.datetime(2001, 1, 1), None, [s]) for i, s in
            enumerate(["b", "a", "c", "d", "e", "f", "f"])]
    w = spark.createDataFrame(rows, _wide(spark).schema)
    skills_ = {r.skill for r in marts.skill_trend(w, top_n=3).collect()}
    assert skills_ == {"f", "a", "b"}            # f has 2; a, b win the tie against c, d, e


def test_health_counts_null_posting(spark):
    fact = spark.createDataFrame([(None, dt.datetime(2023, 1, 1, 5)), ("a", dt.datetime(2023, 1, 1, 6)),
                                  ("b", dt.datetime(2023, 1, 2))], "job_id string, search_time timestamp_ntz")
    assert marts.health_num_jobs(fact).first().num_jobs == 3          # COUNT(*) counts the NULL posting
    daily = {r.search_date: r.jobs_daily for r in marts.health_jobs_daily(fact).collect()}
    assert daily == {dt.date(2023, 1, 1): 1, dt.date(2023, 1, 2): 1}   # COUNT(job_id) does not
    assert marts.health_last_update(fact).first().last_update == dt.datetime(2023, 1, 2)


def test_ansi_safe_division_and_index(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("5",), ("x",)], "job_salary string")
    out = df.select(*[c.alias(n) for n, c in salary.parse_salary_columns("job_salary").items()]).collect()
    assert out[0].salary_rate is None and out[1].salary_avg is None      # no exception under ANSI
    views = spark.createDataFrame([("DE", 1, 0)], "Geography string, Views long, `Watch time (hours)` long")
    codes = spark.createDataFrame([("DE", "Germany")], "code string, country string")
    assert geo.country_weights(views, codes).first().percent is None     # 0/0 -> NULL, no error


def test_element_values_and_star_exclusion(spark):
    df = spark.createDataFrame([(1, [("a",), ("b",)])], "k int, kw array<struct<element string>>")
    assert df.select(public.element_values("kw").alias("v")).first().v == ["a", "b"]


def test_cluster_conf_sizes_partitions():
    from hirelake.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4, executors_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600      # 100 TB / 256 MB
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10 * 1024 ** 3, executors_cores=8000)["spark.sql.shuffle.partitions"]) == 24000


def test_time_handling_ignores_session_zone(spark):
    from hirelake.streaming.landing import event_instant, utc_date
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2023-01-05 23:59:59 UTC",), ("1999-09-05 00:00:00 UTC",), ("bad",)], "s string")
        parsed = [r.t for r in df.select(fact_ops.parse_zoned_time("s").alias("t")).collect()]
        assert parsed == [dt.datetime(2023, 1, 5, 23, 59, 59), dt.datetime(1999, 9, 5), None]
        days = df.select(fact_ops.parse_zoned_time("s").alias("search_time")).where("search_time IS NOT NULL")
        got = [r.d for r in days.select(utc_date(F.window(event_instant("search_time"), "1 day").start)
                                        .alias("d")).collect()]
        assert got == [dt.date(2023, 1, 5), dt.date(1999, 9, 5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
