"""Day-level partials of the marts: what a batch of postings adds to them.

A batch (a day's load) is counted once, into tables that are some thousand
times smaller than its postings, and every mart is a sum over those tables.
Partials of a batch never change when another batch comes, so a new day reads
its own postings only; marts of a bounded timeframe read the months they span
(``search_month`` is the partition column, and its bound is a literal).

* ``skills``: (search_month, search_day, title, country, skill) with postings
  and job ids.
* ``sizes``: (search_month, search_day, title, country) with postings, job ids
  and the latest search time.
* ``pay``: (search_month, search_day, skill) with the count, sum, minimum and
  maximum of the yearly pay and its KLL sketch, which merges into the sketch of
  any set of days.

All three are sums, minima, maxima or merged sketches, so a skill that a third of
the postings list is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONTH_COL, TIMEFRAME_NAMES, in_timeframe, month_of, timeframe_start
from . import marts

DAY = "search_day"
#: Size of a sketch: a median's rank is then within RANK_ERROR of the middle,
#: merged or not, for 99 of 100 sketches.
KLL_K, RANK_ERROR = 800, 0.005


def _days(wide: DataFrame, ts: str) -> DataFrame:
    return wide.withColumns({MONTH_COL: month_of(ts), DAY: F.to_date(ts)})


def skill_partials(wide: DataFrame, *, skills: str = marts.SKILLS, job_id: str = marts.JOB_ID, title: str = marts.TITLE,
                   country: str = marts.COUNTRY, ts: str = marts.TS) -> DataFrame:
    """Postings per day, title, country and skill (``n_rows``), and those with a
    job id (``n_jobs``)."""
    return (_days(wide, ts).select(MONTH_COL, DAY, title, country, job_id, F.explode(skills).alias("skill"))
            .groupBy(MONTH_COL, DAY, F.col(title).alias("title"), F.col(country).alias("country"), "skill")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(job_id).alias("n_jobs")))


def size_partials(wide: DataFrame, *, job_id: str = marts.JOB_ID, title: str = marts.TITLE, country: str = marts.COUNTRY,
                  ts: str = marts.TS) -> DataFrame:
    """Postings per day, title and country, also those without skills."""
    return (_days(wide, ts).groupBy(MONTH_COL, DAY, F.col(title).alias("title"), F.col(country).alias("country"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(job_id).alias("n_jobs"), F.max(ts).alias("last_search")))


def pay_partials(wide: DataFrame, *, skills: str = marts.SKILLS, salary: str = marts.SALARY, job_id: str = marts.JOB_ID,
                 ts: str = marts.TS, k: int = KLL_K) -> DataFrame:
    """Yearly pay per day and skill, with a mergeable sketch of it."""
    pay = F.col(salary).cast("double")
    return (_days(wide, ts).where(F.col(salary).isNotNull())
            .select(MONTH_COL, DAY, job_id, pay.alias("pay"), F.explode(skills).alias("skill"))
            .groupBy(MONTH_COL, DAY, "skill")
            .agg(F.count(job_id).alias("n_jobs"), F.count("pay").alias("n_pay"), F.sum("pay").alias("sum"), F.min("pay").alias("min"),
                 F.max("pay").alias("max"), F.kll_sketch_agg_double("pay", F.lit(k)).alias("sketch")))


def merged(partials: DataFrame) -> DataFrame:
    """The partials of all batches as those of one (compaction)."""
    how = {"n_rows": F.sum, "n_jobs": F.sum, "n_pay": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "last_search": F.max,
           "sketch": F.kll_merge_agg_double}
    keys = [c for c in partials.columns if c not in how]
    return partials.groupBy(*keys).agg(*(how[c](c).alias(c) for c in partials.columns if c in how)).select(*partials.columns)


def since(partials: DataFrame, name: str, as_of) -> DataFrame:
    """The partials of a timeframe; the bound on the month is folded to a
    literal, so that the scan skips older partitions."""
    start = timeframe_start(name, as_of)
    if start is None:
        return partials
    return partials.where((F.col(MONTH_COL) >= F.trunc(start, "month")) & (F.col(DAY) >= start))


def _by_timeframe(partials: DataFrame, as_of) -> DataFrame:
    """Each partial once for every timeframe that it is in."""
    names = F.array(*(F.when(in_timeframe(DAY, n, as_of), F.lit(n)) for n in TIMEFRAME_NAMES))
    return partials.select("*", F.explode(names).alias("timeframe")).where(F.col("timeframe").isNotNull())


# ------------------------------------------------------------------- marts
def skills_by_timeframe(skills: DataFrame, sizes: DataFrame, as_of) -> DataFrame:
    """M1 from partials."""
    totals = _by_timeframe(sizes, as_of).groupBy("timeframe").agg(F.sum("n_rows").alias("total_jobs"))
    counts = _by_timeframe(skills, as_of).groupBy("skill", "timeframe").agg(F.sum("n_jobs").alias("skill_count"))
    # one row per timeframe: four at most
    return (counts.join(F.broadcast(totals), "timeframe")
            .select("skill", F.try_divide("skill_count", "total_jobs").alias("skill_percent"), "skill_count", "total_jobs", "timeframe")
            .orderBy("timeframe", F.desc("skill_count")))


def title_country_counts(sizes: DataFrame) -> DataFrame:
    """M2 from partials."""
    return (sizes.where(F.col("country").isNotNull())
            .groupBy(F.col("title").alias("job_title"), F.col("country").alias("search_country"))
            .agg(F.sum("n_rows").alias("job_count")).orderBy(F.desc("job_count")))


def skill_grains(skills: DataFrame, sizes: DataFrame, as_of, *, title: str = marts.TITLE, country: str = marts.COUNTRY) -> DataFrame:
    """M4-M7 from partials, all timeframes."""
    def counted(partials, n):
        return _by_timeframe(partials, as_of).withColumnsRenamed({"title": title, "country": country}).withColumn("_n", F.col(n))

    return marts._shares(counted(skills, "n_jobs"), counted(sizes, "n_rows"), ["timeframe"], title, country).orderBy(
        "timeframe", F.desc("skill_count"))


def skill_trend(skills: DataFrame, sizes: DataFrame, *, top_n: int = 5, window_rows: int = 14) -> DataFrame:
    """M8 from partials: rolling share of the top skills."""
    daily = skills.groupBy(F.col(DAY).alias("date"), "skill").agg(F.sum("n_rows").alias("_n"))
    top = (daily.groupBy("skill").agg(F.sum("_n").alias("_total"), F.collect_list(F.struct("date", "_n")).alias("_days"))
           .orderBy(F.desc("_total"), "skill").limit(top_n).where(F.col("skill").isNotNull()))
    # one row per day: the unpartitioned windows see days, not postings
    days = Window.orderBy("date")
    day_totals = sizes.groupBy(F.col(DAY).alias("date")).agg(F.sum("n_rows").alias("_day_total"))
    rolling = day_totals.select("date", F.sum("_day_total").over(days.rowsBetween(-(window_rows - 1), 0)).alias("_rolling"),
                                F.sum("_day_total").over(days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                                .cast("bigint").alias("total_jobs"))
    frame = Window.partitionBy("skill").orderBy("date").rowsBetween(-(window_rows - 1), 0)
    return (top.select("skill", F.inline("_days")).join(rolling, "date")
            .select("date", "skill", F.try_divide(F.sum("_n").over(frame), F.col("_rolling")).alias("skill_percentage"), "total_jobs")
            .orderBy(F.desc("date"), F.desc("skill_percentage")))


def health(sizes: DataFrame) -> dict[str, DataFrame]:
    """M13-M15 from partials."""
    return {"num_jobs": sizes.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("num_jobs")),
            "dates": sizes.groupBy(F.col(DAY).alias("search_date")).agg(F.sum("n_jobs").alias("jobs_daily")).orderBy("search_date"),
            "last_update": sizes.agg(F.max("last_search").alias("last_update"))}


def skill_pay(pay: DataFrame, as_of) -> DataFrame:
    """A8 / M9 from partials, per timeframe: (skill, timeframe, count, avg, min,
    max, median) of the yearly pay.  The median comes from the merged sketches:
    its rank is within RANK_ERROR of the middle (see KLL_K)."""
    return (_by_timeframe(pay, as_of).groupBy("skill", "timeframe")
            .agg(F.sum("n_jobs").alias("count"), (F.sum("sum") / F.sum("n_pay")).alias("avg"), F.min("min").alias("min"), F.max("max").alias("max"),
                 F.kll_merge_agg_double("sketch").alias("sketch"))
            .select("skill", "timeframe", "count", "avg", "min", "max",
                    F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median")))


def rank_of(wide: DataFrame, found: DataFrame, as_of, *, skills: str = marts.SKILLS, salary: str = marts.SALARY,
            ts: str = marts.TS, value: Column | str = "median") -> DataFrame:
    """``found`` (skill, timeframe, median ...) with the exact ranks of its
    median among the pays it stands for: ``below`` and ``upto`` (shares of pays
    under it, and not over it), by one more pass over the postings."""
    names = F.array(*(F.when(in_timeframe(ts, n, as_of), F.lit(n)) for n in TIMEFRAME_NAMES))
    pays = (wide.where(F.col(salary).isNotNull()).select(F.col(salary).cast("double").alias("pay"), ts, F.explode(skills).alias("skill"))
            .select("pay", "skill", F.explode(names).alias("timeframe")).where(F.col("timeframe").isNotNull())
            .groupBy("skill", "timeframe", "pay").agg(F.count(F.lit(1)).alias("n")))
    v = F.col(value) if isinstance(value, str) else value
    both = pays.join(found, ["skill", "timeframe"])
    rest = [c for c in found.columns if c not in ("skill", "timeframe")]
    return (both.groupBy("skill", "timeframe", *rest)
            .agg((F.sum(F.when(F.col("pay") < v, F.col("n")).otherwise(0)) / F.sum("n")).alias("below"),
                 (F.sum(F.when(F.col("pay") <= v, F.col("n")).otherwise(0)) / F.sum("n")).alias("upto")))
