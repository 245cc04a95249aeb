"""Readers for parquet tables (S2/S3): schema from the files, columns pruned
and filters pushed down by Catalyst because nothing here is an action."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


#: Set by the caller's session, never by the size of an input; unset on a cluster.
SCAN_TASKS = "spark.hirelake.scanTasks"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None, *, heavy: bool = False) -> DataFrame:
    """Scan of an input table.  ``heavy``: much work per row follows before any
    shuffle; where the session names a number of tasks in SCAN_TASKS (inputs of
    one row group, as in tests and the bench), the rows are dealt to them."""
    df = spark.read.parquet(table_path(sf_dir, name))
    tasks = spark.conf.get(SCAN_TASKS, None) if heavy else None
    if tasks:
        df = df.repartition(int(tasks))
    return df.select(*columns) if columns else df


# FIXED VALUES: the columns of the typed landing table.
TYPED_LANDING_SCHEMA = (
    "title string, company_name string, location string, via string, description string, "
    "extensions array<string>, job_id string, thumbnail string, posted_at string, "
    "schedule_type string, work_from_home boolean, salary string, search_term string, "
    "date_time timestamp_ntz, search_location string, commute_time string"
)


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str = TYPED_LANDING_SCHEMA,
               fmt: str = "parquet") -> DataFrame:
    """Scan with a fixed schema (no inference on large inputs)."""
    return spark.read.schema(schema).format(fmt).load(path)


PAGE_SCHEMA = ("search_term string, search_location string, result_offset bigint, "
               "error boolean, results string")


#: Where a reader puts a line that it can't read.
CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, *, fmt: str = "json", corrupt: bool = False) -> DataFrame:
    """S1/K2 batch side: landed raw pages (one JSON object per line), fixed
    schema.  ``corrupt``: with a column that holds a line which is no such object."""
    schema = f"{PAGE_SCHEMA}, {CORRUPT} string" if corrupt else PAGE_SCHEMA
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).format(fmt).load(path)


def read_where(df: DataFrame, columns: list[str], predicate: Column) -> DataFrame:
    """S3: the "select these columns where ..." source query, expressed lazily
    so that Catalyst prunes columns and pushes the predicate into the scan."""
    return df.select(*columns).where(predicate)
