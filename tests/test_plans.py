"""Plan shape checks: pushdown, pruning, no single-partition exchange on raw rows."""

import os
import tempfile

from pyspark.sql import functions as F

from hirelake.operators import marts, salary
from hirelake.plans import catalog
from hirelake.plans.pipeline import Inputs, build_all
from hirelake.sources import adapters as ad


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_salary_source_pushes_filter_and_prunes(spark, smoke_dir):
    typed = spark.read.parquet(f"{smoke_dir}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_orderpriority").alias("job_salary"),
        "o_totalprice")
    plan = _plan(salary.salary_dimension(typed))
    assert "PushedFilters: [IsNotNull(o_orderpriority)]" in plan
    assert "o_totalprice" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_numbering_has_no_single_partition_exchange_on_rows(spark, smoke_dir):
    df = catalog.QUERIES["skill_pay_all"](spark, smoke_dir)
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    # The only single-partition exchange carries the per-partition counts
    # (one row per range partition), never posting rows.
    assert singles
    assert all("keys=[_part" in lines[i + 1] for i in singles)


def test_timeframe_totals_are_merged_scalar_subqueries(spark, smoke_dir):
    df = marts.skills_by_timeframe(ad.postings_wide(spark, smoke_dir), ad.AS_OF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the four totals read the wide view in one merged aggregate
    assert plan.count("scalar-subquery") >= 1


def test_build_all_end_to_end(spark, smoke_dir):
    out = tempfile.mkdtemp(prefix="hirelake-build-")
    inputs = Inputs(pages=ad.raw_pages(spark, smoke_dir), typed=ad.typed_postings(spark, smoke_dir),
                    country=ad.country_dim(spark, smoke_dir))
    result = build_all(spark, inputs, out, ad.AS_OF)
    assert set(result) >= {"skills", "alltime", "skill_trend", "skill_pay_all", "public", "dates"}
    for name, df in result.items():
        df.limit(5).collect()
    assert os.path.isdir(os.path.join(out, "wide"))
    fact = spark.read.parquet(os.path.join(out, "fact"))
    assert result["num_jobs"].first().num_jobs == fact.count()


def _executed(df):
    """The final adaptive plan: of the very query execution that has run."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    plan = run.executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


def test_unexecuted_plan_is_not_taken_for_a_final_one(spark, smoke_dir):
    df = marts.skill_grains(ad.postings_wide(spark, smoke_dir))
    df.write.format("noop").mode("overwrite").save()
    assert "isFinalPlan=true" not in df._jdf.queryExecution().executedPlan().toString()


def test_hot_job_id_is_split_in_both_dimension_joins(spark, tmp_path):
    """Half of all postings carry one job id: AQE splits it in both joins on job_id
    (the dimensions are stored tables, as in the daily build)."""
    from hirelake.operators import wide
    names = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        n = 100_000
        base = spark.range(0, n, 1, 4).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("job_id"),
            F.md5(F.col("id").cast("string")).alias("job_description"), F.lit("t").alias("job_title"),
            F.lit("term").alias("search_term"), F.lit("place").alias("search_location"))
        ids = base.select("job_id").distinct()
        ids.select("job_id", F.lit("d").alias("job_description"), F.array(F.lit("sql")).alias("keywords_all")
                   ).write.parquet(str(tmp_path / "skills"))
        ids.select("job_id", F.lit(1.0).alias("salary_avg")).write.parquet(str(tmp_path / "pay"))
        skills, pay = (spark.read.parquet(str(tmp_path / d)) for d in ("skills", "pay"))
        country = spark.createDataFrame([("place", "country")], "search_location string, search_country string")
        titles = spark.createDataFrame([("t", "title")], "job_title string, job_title_clean string")
        plan = _executed(wide.build_wide(base, skills, country, pay, titles))
        joins = [line for line in plan.split("\n") if "Join" in line]
        assert len([line for line in joins if "skew=true" in line and "_j" in line]) == 2, plan
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_trend_reads_the_wide_table_twice_and_explodes_once(spark, smoke_dir, tmp_path):
    ad.postings_wide(spark, smoke_dir).write.parquet(str(tmp_path / "w"))
    plan = _executed(marts.skill_trend(spark.read.parquet(str(tmp_path / "w"))))
    assert plan.count("FileScan") == 2
    assert plan.count("Generate explode") == 1


def test_dedup_combines_before_shuffle_under_skew(spark):
    """A third of all rows share one key: the survivor choice is a partial
    aggregate before the exchange, so the hot key is reduced map-side."""
    from hirelake.operators.dedup import dedup_by_key
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    out = dedup_by_key(df, ["k"], ["v"])
    plan = _executed(out)
    assert "partial_min" in plan
    assert out.where("k = 'hot'").first().v == 0
    assert out.count() == 20001


def test_grains_expand_counts_not_postings(spark, smoke_dir, tmp_path):
    """Above every scan the postings are counted (and shuffled) before an Expand sees them."""
    ad.postings_wide(spark, smoke_dir).write.parquet(str(tmp_path / "w"))
    plan = _executed(marts.skill_grains(spark.read.parquet(str(tmp_path / "w"))))
    lines = plan.split("\n")
    expands = [i for i, line in enumerate(lines) if "Expand [" in line]
    assert len(expands) == 2
    for i in expands:
        below = "\n".join(lines[i + 1:])
        assert below.index("Exchange") < below.index("partial_count") < below.index("FileScan")


def test_timeframe_marts_prune_month_partitions(spark, smoke_dir):
    from hirelake.functions.columns import LAST_7, MONTH_COL, month_of
    out = tempfile.mkdtemp(prefix="hirelake-part-")
    w = ad.postings_wide(spark, smoke_dir)
    w.withColumn(MONTH_COL, month_of("search_time")).write.partitionBy(MONTH_COL).parquet(out + "/w")
    stored = spark.read.parquet(out + "/w")
    df = marts.skill_grains(stored, ad.AS_OF, LAST_7)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(search_month" in plan and "2001-07-01" in plan
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, df.collect())) == sorted(map(key, marts.skill_grains(w, ad.AS_OF, LAST_7).collect()))


def test_build_all_grains_equal_per_timeframe(spark, smoke_dir):
    from hirelake.functions.columns import LAST_30
    out = tempfile.mkdtemp(prefix="hirelake-build-")
    inputs = Inputs(pages=ad.raw_pages(spark, smoke_dir), typed=ad.typed_postings(spark, smoke_dir),
                    country=ad.country_dim(spark, smoke_dir))
    result = build_all(spark, inputs, out, ad.AS_OF)
    wide_df = spark.read.parquet(os.path.join(out, "wide"))
    direct = marts.skill_grains(wide_df, ad.AS_OF, LAST_30)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, result["30day"].collect())) == sorted(map(key, direct.collect()))


def test_second_day_appends_new_ids_only(spark, smoke_dir):
    """Two days of pages give the tables that one full build gives."""
    pages, typed, country = ad.raw_pages(spark, smoke_dir), ad.typed_postings(spark, smoke_dir), ad.country_dim(spark, smoke_dir)
    late = F.get_json_object("results", "$.search_metadata.created_at") >= "2000-01-01"
    two, one = tempfile.mkdtemp(prefix="hirelake-two-"), tempfile.mkdtemp(prefix="hirelake-one-")
    build_all(spark, Inputs(pages.where(~F.coalesce(late, F.lit(False))), typed, country), two, ad.AS_OF)
    before = spark.read.parquet(f"{two}/skills").count()
    build_all(spark, Inputs(pages.where(F.coalesce(late, F.lit(False))), typed, country), two, ad.AS_OF)
    build_all(spark, Inputs(pages, typed, country), one, ad.AS_OF)
    skills = spark.read.parquet(f"{two}/skills")
    assert before < skills.count() == skills.select("job_id").distinct().count()
    for name in ("fact", "salary", "titles", "skills", "wide", "public"):
        a, b = (spark.read.parquet(f"{d}/{name}") for d in (two, one))
        assert a.count() == b.count(), name
    assert spark.read.parquet(f"{two}/fact").exceptAll(spark.read.parquet(f"{one}/fact").select(
        *spark.read.parquet(f"{two}/fact").columns)).count() == 0
