"""Values that several columns use are worked out once a row: the plans hold
each of them once, and the results are those of the rules."""

import datetime
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from hirelake.operators import fact, pages, salary
from hirelake.plans import catalog
from hirelake.sources import adapters as ad
from hirelake.sources import sinks

SHREDDING = "spark.sql.variant.inferShreddingSchema"
PAGE = ("search_term string, search_location string, result_offset bigint, error boolean, results string")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_page_metadata_is_read_once(spark):
    """load_audit read the page's time about 150 times a page."""
    def page(time, hl='"hl":"en"', more='"total_time_taken":1.5'):
        return f'{{"search_metadata":{{"id":"s","created_at":"{time}",{more}}},"search_parameters":{{{hl}}},"jobs_results":[]}}'

    texts = [page("2023-01-05 10:00:07 UTC"), page("2023-01-05 10:00:07"), page("2023-02-30 10:00:07 UTC"), page("2023-01-05 10:00:60 UTC"),
             page("2023-01-05 10:00:07 UTC", hl=""), page("2023-01-05 10:00:07 UTC", more='"total_time_taken":"x"'), "no JSON", None,
             '{"search_metadata":"s","search_parameters":[]}', "[]"]
    rows = fact.archive_rows(spark.createDataFrame([("t", "l", i, False, x) for i, x in enumerate(texts)], PAGE))
    found = {r.result_offset: r for r in rows.drop("results").collect()}
    assert found[0].search_time == datetime.datetime(2023, 1, 5, 10, 0, 7)
    assert (found[0].search_id, found[0].search_time_taken, found[0].search_language) == ("s", 1.5, "en")
    assert found[3].search_time == datetime.datetime(2023, 1, 5, 10, 1)
    for i in (1, 2, 4, 5, 6, 7, 8, 9):
        assert found[i].search_id is None and found[i].search_time is None and found[i].search_language is None, i
    plan = _plan(rows)
    assert plan.lower().count("created_at") <= 10 and plan.count("regexp_extract") == 0 and plan.count("RLIKE") <= 1


def test_page_text_is_made_once(spark, smoke_dir):
    """the JSON of a page stood 4 times in the plan, once for each change made to it."""
    raw = ad.raw_pages(spark, smoke_dir, None)
    assert _plan(raw).count("StructsToJsonEvaluator") <= 2
    row = raw.select(F.count(F.lit(1)).alias("n"), F.count(F.try_parse_json("results")).alias("good")).first()
    assert row.n == row.good > 0


def test_stored_pages_keep_their_variant_whole(spark, smoke_dir):
    """page_fields read pages that the writer had parted into columns of an inferred schema."""
    before = spark.conf.get(SHREDDING, None)
    path = sinks.scratch_path(spark, "whole")
    sinks.write_table(catalog.archive(spark, smoke_dir, None), path)
    assert spark.conf.get(SHREDDING, None) == before
    for file in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        assert "typed_value" not in str(pq.ParquetFile(file).schema)
    back = spark.read.parquet(path).select(F.try_variant_get("results", "$.search_metadata.id", "string").alias("id"))
    assert back.where("id IS NOT NULL").count() == back.count() > 0


def test_landing_reads_values_outside_the_search_by_name(spark):
    """landing_by_data read each value again for every field's name."""
    jobs = [('{"title":"a","via":{"x":1},"new":[1],"detected_extensions":{"salary":"5","posted_at":null}}', "A"),
            ('{"title":"b","via":"w","work_from_home":true,"detected_extensions":{"title":"no","work_from_home":false}}', "B"),
            ('{"title":null,"via":null,"work_from_home":"odd"}', "C"), ('{"title":"d"}', "D")]
    df = spark.createDataFrame([(t, "l", False, f'{{"jobs_results":[{j}]}}') for j, t in jobs],
                               "search_term string, search_location string, error boolean, results string")
    profile = spark.createDataFrame([("title", "STRING"), ("via", "VARIANT"), ("salary", "STRING"), ("work_from_home", "BOOLEAN"),
                                     ("posted_at", "VOID")], "field string, type string")
    rows = pages.landing_by_data(df, load_time=F.lit("2024-01-01").cast("timestamp_ntz"), profile=profile)
    assert sorted(rows.columns) == ["date_time", "rescued", "salary", "search_location", "search_term", "title", "via", "work_from_home"]
    found = {r.search_term: (r.title, r.via, r.salary, r.work_from_home, r.rescued) for r in rows.collect()}
    assert found == {"A": ("a", None, "5", None, '{"new":[1],"via":{"x":1}}'), "B": ("b", "w", None, True, None),
                     "C": (None, None, None, None, '{"work_from_home":"odd"}'), "D": ("d", None, None, None, None)}
    last = next(x for x in _plan(rows).splitlines() if "map_filter" in x)
    assert "try_variant_get" not in last[last.index("map_filter"):]


def test_salary_text_is_parsed_once(spark):
    """F8: salary_wide's parse stood in each of its columns, up to 26 times in one."""
    texts = ["62K–65K a year", "20–25.5 an hour", "4,500 a month", "$30.5K a year", "Competitive", "a–b a year", "5K–x an hour", "", None, "7"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "job_id string, job_salary string")
    for compat in (False, True):
        plain = df.select("job_id", *[c.alias(n) for n, c in salary.parse_salary_columns("job_salary", compat=compat).items()])
        steps = salary.with_salary(df, "job_salary", compat=compat).drop("job_salary")
        assert sorted(map(str, plain.collect())) == sorted(map(str, steps.collect()))
    one = {r.job_id: r for r in salary.salary_dimension(df).collect()}
    assert one["0"].salary_avg == one["0"].salary_year == 63500 and one["3"].salary_year == 30500 and one["4"].salary_avg is None
    assert one["1"].salary_hour == 22.75 and one["2"].salary_avg == 4500 and one["2"].salary_year is None
    assert _plan(salary.salary_dimension(df)).count("split(") <= 2
