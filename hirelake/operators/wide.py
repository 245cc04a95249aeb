"""M17 star join and M18 salary-wide projection.

The two job-id dimensions (skills, salary) hold one row per job id and are
as large as the fact, so they are joined first: both joins are keyed on
job_id, and Spark reuses the fact's hash partitioning for the second one
(one shuffle of the fact).  The country and title dimensions are small by
nature (one row per location / distinct title); they are not hinted: AQE
turns those joins into broadcasts only after measuring their real size,
and keeps a shuffle join beyond the threshold.  Fact rows with a NULL job
id get join keys of their own (a hash of the row) that match nothing; a hot
non-NULL job id (one posting seen in many searches) meets a single dimension
row, and AQE's skew-join split divides it where
``spark.sql.adaptive.forceOptimizeSkewedJoin`` is set (session helpers set it):
the second job-id join reuses the first one's partitioning, and AQE otherwise
drops a split that would add a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALARY_WIDE_COLUMNS = [
    "search_term", "salary_avg", "salary_min", "salary_max", "salary_year", "salary_hour",
    "search_location", "job_location", "job_schedule_type", "job_via", "search_country", "search_time",
]


def build_wide(fact: DataFrame, skills: DataFrame, country: DataFrame, salary: DataFrame,
               titles: DataFrame, *, key: str = "job_id") -> DataFrame:
    """J1 + P12 + P13: fact LEFT JOIN skills, salary (job_id), country
    (search_location), titles (job_title).

    Columns: job_title_final, title dim (minus job_title), fact, skills
    (minus job_id, job_description), country (minus search_location),
    salary (minus job_id)."""
    s = skills.drop("job_description")
    t_cols = [c for c in titles.columns if c != "job_title"]
    s_cols = [c for c in s.columns if c != key]
    c_cols = [c for c in country.columns if c != "search_location"]
    d_cols = [c for c in salary.columns if c != key]
    # A NULL job id can match no dimension row, and the NULL postings of
    # empty pages can be a large share of the fact.  They get a join key
    # that no job id has (a NUL-prefixed hash of the row), so they spread over the shuffle instead of forming one hot partition,
    # still match nothing, and the fact is read in a single pass.
    hashable = [F.col(c) for c, t in fact.dtypes if not t.startswith(("map", "variant"))]
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*hashable).cast("string"))
    f = fact.withColumn("_jk", F.coalesce(F.col(key).cast("string"), salt))
    sk = s.withColumn("_sk", F.col(key).cast("string")).drop(key)
    dk = salary.withColumn("_dk", F.col(key).cast("string")).drop(key)
    joined = (f.join(sk, f["_jk"] == sk["_sk"], "left")
              .join(dk, f["_jk"] == dk["_dk"], "left")
              .join(country, "search_location", "left")
              .join(titles, "job_title", "left"))
    final = F.coalesce(F.col("job_title_clean"), F.col("search_term"))       # P12
    return joined.select(final.alias("job_title_final"), *t_cols, *fact.columns,
                         *s_cols, *c_cols, *d_cols)


def salary_wide(wide: DataFrame) -> DataFrame:
    """Postings with a parsed salary, as the salary page uses them."""
    return (wide.where(F.col("salary_avg").isNotNull())
            .select(F.col("job_title_final").alias("job_title"), *SALARY_WIDE_COLUMNS))
