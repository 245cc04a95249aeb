"""End-to-end daily build (entry point B of the reference) as one Spark job set.

pages -> archive and landing (batches) -> fact -> salary / skills / titles dimensions ->
wide -> marts, public table.  Every table is written and read back, so pages
are parsed once and a description is tagged once: on later days only job ids
and titles that the stored skills and titles lack are enriched and appended.
Writing also cuts the lineage, so a lost executor re-runs at most one stage.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ALL_TIME, LAST_7, LAST_30, MONTH_COL, YTD, month_of
from ..operators import fact as fact_ops
from ..operators import marts, public, salary, skills, titles, wide
from ..sources import sinks
from ..sources.batches import BatchTable


@dataclass
class Inputs:
    pages: DataFrame        # search_term, search_location, result_offset, error, results
    typed: DataFrame        # 16-column typed landing table
    country: DataFrame      # search_location, search_country
    title_dim: DataFrame | None = None   # job_title, job_title_clean (existing labels)
    skill_dim: DataFrame | None = None   # existing skills dimension (appended to)


def archive_batch(archive: BatchTable, landing: BatchTable, batch: str, pages: DataFrame) -> None:
    """K2 and K3, repeatable: pages that the archive lacks, by their key, and
    the typed rows of the pages that the batch added."""
    rows = fact_ops.archive_rows(pages)
    rows = rows.withColumns({"page_key": fact_ops.page_key(rows), MONTH_COL: month_of("search_time")})
    archive.append(batch, rows, key="page_key", order=F.sha2(F.to_json(F.col("results")), 256))
    added = archive.read([batch])
    if added is not None and not landing.has(batch):
        typed = fact_ops.landing_rows(added)
        landing.append(batch, typed.withColumn(MONTH_COL, month_of("date_time")))


def build_all(spark: SparkSession, inputs: Inputs, out: str, as_of, *,
              title_labels=None, batch: str | None = None) -> dict[str, DataFrame]:
    """Add the landed pages to the archive, rebuild the tables under ``out``
    and return the marts (lazy).

    A build may be run again, also after it was killed: pages that the archive
    has are not added twice, and a ``batch`` (its name) that is loaded not at
    all; all other tables are rebuilt or get the keys that they lack."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}")

    archive = BatchTable(spark, f"{out}/archive", [MONTH_COL])
    archive_batch(archive, BatchTable(spark, f"{out}/landing", [MONTH_COL]),
                  batch or f"load-{uuid.uuid4().hex}", inputs.pages)             # K2, K3
    fact = fact_ops.build_fact(archive.read(), inputs.typed)
    # Stored by search month: timeframe marts prune old partitions at the scan.
    sinks.write_table(fact.withColumn(MONTH_COL, month_of("search_time")), f"{out}/fact",
                      partition_by=[MONTH_COL])                                  # K1
    fact = table("fact").drop(MONTH_COL)

    sinks.write_table(salary.salary_dimension(fact), f"{out}/salary")            # K5
    known = sinks.stored(spark, f"{out}/skills")
    if known is not None or inputs.skill_dim is not None:                        # T3: new ids only
        given = inputs.skill_dim if known is None else known
        new = skills.skills_dimension(fact.join(given.select("job_id"), "job_id", "left_anti"))
        rows = (given if known is None else given.limit(0)).unionByName(new, allowMissingColumns=True)
    else:
        rows = skills.skills_dimension(fact)
    sinks.append_rows(rows, f"{out}/skills")                                     # K4
    skill_dim = table("skills")
    kw = {} if title_labels is None else {"labels": title_labels}
    known = sinks.stored(spark, f"{out}/titles")
    if known is not None:
        rows = titles.new_title_labels(fact, known, **kw)
    elif inputs.title_dim is not None:
        rows = inputs.title_dim.unionByName(titles.new_title_labels(fact, inputs.title_dim, **kw))
    else:
        rows = titles.classify_titles(fact, **kw)
    sinks.append_rows(rows, f"{out}/titles")                                     # K6
    salary_dim, title_dim = table("salary"), table("titles")

    w = wide.build_wide(fact, skill_dim, inputs.country, salary_dim, title_dim)
    sinks.write_table(w.withColumn(MONTH_COL, month_of("search_time")), f"{out}/wide",
                      partition_by=[MONTH_COL])
    w = table("wide")
    sinks.write_table(skills.keyword_listing(skill_dim), f"{out}/keywords")
    sinks.write_table(wide.salary_wide(w), f"{out}/salary_wide")
    sinks.write_table(public.public_table(w.drop(MONTH_COL)), f"{out}/public")
    # All four grain marts from one pass, stored once (aggregated: small).
    sinks.write_table(marts.skill_grains_all_timeframes(w, as_of), f"{out}/grains")
    grains = table("grains")

    def grain(name):
        return grains.where(F.col("timeframe") == name).drop("timeframe")

    return {
        "skills": marts.skills_by_timeframe(w, as_of),
        "slicer": marts.title_country_counts(w),
        "keywords": table("keywords"),
        "alltime": grain(ALL_TIME),
        "7day": grain(LAST_7),
        "30day": grain(LAST_30),
        "ytd": grain(YTD),
        "skill_trend": marts.skill_trend(w),
        "skill_pay": marts.skill_pay(w),
        "skill_pay_slicer": marts.skill_pay_slicer(w),
        "skill_pay_all": marts.skill_pay_all(w),
        "salary": marts.salary_mart(table("salary_wide")),
        "num_jobs": marts.health_num_jobs(fact),
        "dates": marts.health_jobs_daily(fact),
        "last_update": marts.health_last_update(fact),
        "public": table("public"),
    }


def export_marts(marts_: dict[str, DataFrame], out: str) -> dict[str, int]:
    """K7: one sharded CSV folder per mart (array columns as '|' text); the
    rows of each, counted while it is written (K9)."""
    counted = {}
    for name, df in marts_.items():
        flat = df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else c
                           for c, t in df.dtypes])
        watched, seen = sinks.audited(flat, name)
        sinks.export_csv(watched, f"{out}/{name}")
        counted[name] = seen.get["rows"]
    return counted
