"""Reporting marts M1-M15 over the wide (or fact) table.

Each mart is one lazy plan.  Where the reference scans the wide table once
per timeframe or per grain and glues the pieces with UNION ALL, the marts here
use conditional aggregation, or GROUPING SETS over counts of one scan; totals are
uncorrelated scalar subqueries, several totals computed by one aggregate.  Keyword arrays are exploded before aggregation, and the
aggregation is partial (map-side), so one very common skill never gathers
its rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (ALL_TIME, TIMEFRAME_NAMES, in_timeframe, timeframe_filter)
from .numbering import number_by_key

# Default column names of the wide table.
JOB_ID = "job_id"
TITLE = "job_title_final"
COUNTRY = "search_country"
TS = "search_time"
SKILLS = "keywords_all"
SALARY = "salary_year"

MEDIAN_ACCURACY = 10000


def _where(df: DataFrame, predicate: Column | None) -> DataFrame:
    """P25: the optional predicate slot of the reference (``WHERE 1 = 1 ...``)."""
    return df if predicate is None else df.where(predicate)


def _count_rows() -> Column:
    return F.count(F.lit(1))


# --------------------------------------------------------------------- M1
def skills_by_timeframe(wide: DataFrame, as_of, *, skills: str = SKILLS, job_id: str = JOB_ID,
                        ts: str = TS, predicate: Column | None = None) -> DataFrame:
    """M1: (skill, skill_percent, skill_count, total_jobs, timeframe).

    skill_count counts job ids of the postings listing the skill inside the
    timeframe; total_jobs counts all postings of the timeframe, also those
    without skills."""
    base = _where(wide, predicate)
    conds = [in_timeframe(ts, name, as_of) for name in TIMEFRAME_NAMES]
    exploded = base.select(job_id, ts, F.explode(skills).alias("skill"))
    aggs = []
    for i, c in enumerate(conds):
        aggs.append(F.count_if(c).alias(f"_rows{i}"))
        aggs.append(F.count(F.when(c, F.col(job_id))).alias(f"_cnt{i}"))
    per_skill = exploded.groupBy("skill").agg(*aggs)
    long = per_skill.select(
        "skill",
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("_tf"), F.col(f"_rows{i}").alias("_rows"),
                     F.col(f"_cnt{i}").alias("skill_count"))
            for i in range(len(conds))])))
    # All four totals in one aggregate over one scan (one scalar subquery).
    totals = base.agg(F.array(*[F.count_if(c) for c in conds]).alias("_totals")).scalar()
    names = F.array(*[F.lit(n) for n in TIMEFRAME_NAMES])
    total = F.element_at(totals, F.col("_tf") + 1)
    return (long.where(F.col("_rows") > 0)
            .select("skill",
                    F.try_divide(F.col("skill_count"), total).alias("skill_percent"),
                    "skill_count",
                    total.alias("total_jobs"),
                    F.element_at(names, F.col("_tf") + 1).alias("timeframe"))
            .orderBy("timeframe", F.desc("skill_count")))


# ------------------------------------------------------------- M2 / M10
def title_country_counts(wide: DataFrame, *, title: str = TITLE, country: str = COUNTRY,
                         predicate: Column | None = None) -> DataFrame:
    """M2 (and M10 with ``salary_year IS NOT NULL``): postings per (title, country)."""
    base = _where(wide.where(F.col(country).isNotNull()), predicate)
    return (base.groupBy(F.col(title).alias("job_title"), F.col(country).alias("search_country"))
            .agg(_count_rows().alias("job_count"))
            .orderBy(F.desc("job_count")))


def skill_pay_slicer(wide: DataFrame, *, salary: str = SALARY, **kw) -> DataFrame:
    """M10."""
    return title_country_counts(wide, predicate=F.col(salary).isNotNull(), **kw)


# ------------------------------------------------------------- M4 - M7
def _roll_up(counts: DataFrame, out: str, keys: list[str], title: str, country: str) -> DataFrame:
    """Sums of ``_n`` at grains (title, country), (title) and (country) within ``keys``."""
    return (counts.groupingSets([[*keys, title, country], [*keys, title], [*keys, country]], *keys, title, country)
            .agg(F.sum("_n").alias(out), (F.grouping(title) * 2 + F.grouping(country)).alias("_g")))


def _shares(counts: DataFrame, sizes: DataFrame, keys: list[str], title: str, country: str) -> DataFrame:
    """Skill counts over grain sizes.  As in the reference's inner joins, a row
    whose grain key is NULL is dropped from that grain."""
    t, c, g = F.col(title), F.col(country), F.col("_g")
    detail = (_roll_up(counts, "skill_count", [*keys, "skill"], title, country)
              .where(((g == 0) & t.isNotNull() & c.isNotNull()) | ((g == 1) & t.isNotNull())
                     | ((g == 2) & c.isNotNull())))
    totals = (_roll_up(sizes, "total_jobs", keys, title, country)
              .withColumnsRenamed({title: "_t", country: "_c", "_g": "_tg", **{k: f"_{k}" for k in keys}}))
    same = (g == F.col("_tg")) & t.eqNullSafe(F.col("_t")) & c.eqNullSafe(F.col("_c"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return (detail.join(totals, same)
            .select(*keys, "skill", title, country,
                    F.try_divide(F.col("skill_count"), F.col("total_jobs")).alias("skill_percent"),
                    "skill_count", "total_jobs"))


def skill_grains(wide: DataFrame, as_of=None, timeframe: str = ALL_TIME, *,
                 skills: str = SKILLS, job_id: str = JOB_ID, title: str = TITLE,
                 country: str = COUNTRY, ts: str = TS) -> DataFrame:
    """M4-M7: skill frequency at grains (title, country), (title), (country).

    Postings are counted once per (skill, title, country) and once per
    (title, country); GROUPING SETS then roll up those counts, not postings."""
    base = timeframe_filter(wide, ts, timeframe, as_of)
    counts = (base.select(job_id, title, country, F.explode(skills).alias("skill"))
              .groupBy("skill", title, country).agg(F.count(job_id).alias("_n")))
    sizes = base.groupBy(title, country).agg(_count_rows().alias("_n"))
    return _shares(counts, sizes, [], title, country).orderBy(F.desc("skill_count"))


def skill_grains_all_timeframes(wide: DataFrame, as_of, *, skills: str = SKILLS, job_id: str = JOB_ID,
                                title: str = TITLE, country: str = COUNTRY, ts: str = TS) -> DataFrame:
    """M4-M7 in one pass: (timeframe, skill, title, country, skill_percent,
    skill_count, total_jobs) for all four timeframes.

    Postings are first counted per (skill, title, country, day) and per
    (title, country, day), so the shuffle carries at most one row per day
    and key, not one per posting; only those day rows are expanded to the
    (up to four) timeframes they belong to.  A timeframe bound is midnight,
    so ``ts >= bound`` equals ``to_date(ts) >= bound``."""
    day = F.to_date(ts)

    def expand(df):
        tfs = F.array(*[F.when(in_timeframe("_day", n, as_of), F.lit(n)) for n in TIMEFRAME_NAMES])
        return df.select("*", F.explode(tfs).alias("timeframe")).where(F.col("timeframe").isNotNull())

    per_day = (wide.select(job_id, title, country, day.alias("_day"), F.explode(skills).alias("skill"))
               .groupBy("skill", title, country, "_day").agg(F.count(job_id).alias("_n")))
    day_sizes = wide.groupBy(title, country, day.alias("_day")).agg(_count_rows().alias("_n"))
    return (_shares(expand(per_day), expand(day_sizes), ["timeframe"], title, country)
            .orderBy("timeframe", F.desc("skill_count")))


# --------------------------------------------------------------------- M8
def skill_trend(wide: DataFrame, *, top_n: int = 5, window_rows: int = 14,
                skills: str = SKILLS, ts: str = TS, predicate: Column | None = None) -> DataFrame:
    """M8: rolling share of the top skills, (date, skill, skill_percentage, total_jobs).

    The rolling frames count rows (days present), not calendar days: a skill
    row exists only on days the skill occurs, totals on every day.

    Two scans: one explodes the skills and counts them per day, and a skill's
    days (at most one entry a day) travel with its total to the top-n."""
    base = _where(wide, predicate)
    daily = (base.select(F.to_date(ts).alias("date"), F.explode(skills).alias("skill"))
             .groupBy("date", "skill").agg(_count_rows().alias("_n")))
    # Top-n with a tie-break by skill; the limit is a proven size bound.
    top = (daily.groupBy("skill").agg(F.sum("_n").alias("_total"), F.collect_list(F.struct("date", "_n")).alias("_days"))
           .orderBy(F.desc("_total"), "skill").limit(top_n).where(F.col("skill").isNotNull()))
    top_days = top.select("skill", F.inline("_days"))
    day_totals = base.groupBy(F.to_date(ts).alias("date")).agg(_count_rows().alias("_day_total"))
    # One row per day: the unpartitioned windows see days, not postings.
    days = Window.orderBy("date")
    rolling = day_totals.select("date", F.sum("_day_total").over(days.rowsBetween(-(window_rows - 1), 0)).alias("_rolling"),
                                F.sum("_day_total").over(days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                                .cast("bigint").alias("total_jobs"))
    skill_frame = Window.partitionBy("skill").orderBy("date").rowsBetween(-(window_rows - 1), 0)
    return (top_days.join(rolling, "date")
            .select("date", "skill", F.try_divide(F.sum("_n").over(skill_frame), F.col("_rolling")).alias("skill_percentage"),
                    "total_jobs")
            .orderBy(F.desc("date"), F.desc("skill_percentage")))


# --------------------------------------------------------------------- M9
def skill_pay(wide: DataFrame, *, salary: str = SALARY, skills: str = SKILLS, job_id: str = JOB_ID,
              accuracy: int = MEDIAN_ACCURACY, predicate: Column | None = None) -> DataFrame:
    """M9: (skill, avg, min, max, median, count, total_jobs) of yearly pay."""
    base = _where(wide, predicate).where(F.col(salary).isNotNull())
    total_jobs = base.agg(_count_rows()).scalar()
    s = F.col(salary)
    return (base.select(job_id, salary, F.explode(skills).alias("skill"))
            .groupBy("skill")
            .agg(F.avg(s).alias("avg"), F.min(s).alias("min"), F.max(s).alias("max"),
                 F.percentile_approx(s, 0.5, accuracy).alias("median"),
                 F.count(job_id).alias("count"))
            .withColumn("total_jobs", total_jobs)
            .orderBy(F.desc("count")))


# -------------------------------------------------------------------- M11
def skill_pay_all(wide: DataFrame, *, salary: str = SALARY, skills: str = SKILLS,
                  job_id: str = JOB_ID, title: str = TITLE, country: str = COUNTRY,
                  ts: str = TS, accuracy: int = MEDIAN_ACCURACY, compat: bool = False) -> DataFrame:
    """Per posting and skill, the median yearly pay with a job number.

    Default: one dense number per distinct job id.  ``compat=True`` numbers
    rows before de-duplicating, as the reference does, so a repeated job id
    gets several numbers and the join fans out."""
    numbered = number_by_key(wide, job_id, "job_number", distinct=not compat)
    rows = (wide.where(F.col(salary).isNotNull())
            .select(job_id, title, country, ts, salary, F.explode(skills).alias("skill")))
    return (rows.join(numbered, job_id)
            .groupBy("job_number", title, country, ts, "skill", job_id)
            .agg(F.percentile_approx(salary, 0.5, accuracy).alias("median"))
            .drop(job_id)
            .orderBy(F.desc(ts)))


# -------------------------------------------------------------------- M12
def salary_mart(salary_wide: DataFrame) -> DataFrame:
    """The salary-wide table as exported."""
    return salary_wide


# -------------------------------------------------------------- M13 - M15
def health_num_jobs(fact: DataFrame) -> DataFrame:
    """Number of fact rows (an empty page's NULL posting counts)."""
    return fact.agg(_count_rows().alias("num_jobs"))


def health_jobs_daily(fact: DataFrame, *, ts: str = TS, job_id: str = JOB_ID) -> DataFrame:
    """Postings per search date (COUNT(job_id): NULL postings do not count)."""
    return (fact.groupBy(F.to_date(ts).alias("search_date"))
            .agg(F.count(job_id).alias("jobs_daily"))
            .orderBy("search_date"))


def health_last_update(fact: DataFrame, *, ts: str = TS) -> DataFrame:
    """Latest search time."""
    return fact.agg(F.max(ts).alias("last_update"))
