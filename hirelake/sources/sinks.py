"""Sinks K1-K10 and CSV lookups.

Writers are ordinary Spark writers; outputs stay sharded (one file per task)
unless the caller asks otherwise.  Scratch outputs go under the session's
reliable checkpoint folder (shared storage on a cluster), never a
machine-local temporary folder.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/hirelake-out/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """K1 / K5: create-or-replace a table (overwrite)."""
    if partition_by:  # a partition's rows meet in a few tasks, not a file from every task
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    # Pages are read whole again: a VARIANT parted into columns of an inferred
    # schema costs more to write, and to put together at each read, than all else.
    with setting(df.sparkSession, "spark.sql.variant.inferShreddingSchema", "false"):
        w.save(path)


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """The session's setting while a write runs; then what it was before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def append_rows(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """K2 / K3 / K4 / K6: append rows to a table."""
    df.write.mode("append").format(fmt).save(path)


def stored(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def export_csv(df: DataFrame, path: str) -> None:
    """K7: sharded CSV export with a header, comma separated, overwrite; a quote
    is doubled, as ``read_csv`` expects, and values keep their outer spaces."""
    (df.write.mode("overwrite").option("header", True).option("sep", ",").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, multi_line: bool = True) -> DataFrame:
    """S5 / K7 read-back: header, quoted fields, ``""`` escapes.  Lookups may
    hold line ends in quotes (``multi_line``, one task a file); without them,
    large files are split.  A value such as ``NA`` stays text (no NULL token is
    configured)."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
            .option("escape", '"').csv(path))


def audited(df: DataFrame, name: str = "load_audit", **splits: Column) -> tuple[DataFrame, Observation]:
    """K9: count rows, and those that meet each of ``splits`` (failed searches,
    unreadable pages), while the write runs (no second pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in splits.items()]), obs


OUTCOME, REASON = "outcome", "reason"
ACCEPTED, REJECTED = "accepted", "rejected"


def routed(df: DataFrame, path: str, reasons: dict[str, Column], *, fmt: str = "parquet") -> dict[str, int]:
    """K9: one write that parts rows into accepted and rejected ones.

    ``reasons``: name -> condition, in order; the first that holds is a rejected
    row's ``reason`` (a condition that is NULL does not hold).  Rows stay whole,
    also what could not be read (the corrupt-record column of a reader).  Each
    side is read by its partition, so accepted rows never scan rejected ones.
    Gives the counts of what was written, read from the outcomes and reasons
    alone: rows, accepted, rejected, and ``reason <name>`` for each."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(list(reasons.items())):
        reason = F.when(holds, F.lit(name)).otherwise(reason)
    rows = df.withColumn(REASON, reason)
    rows = rows.withColumn(OUTCOME, F.when(F.col(REASON).isNull(), ACCEPTED).otherwise(REJECTED))
    rows.write.mode("overwrite").format(fmt).partitionBy(OUTCOME).save(path)
    stored = df.sparkSession.read.schema(f"{REASON} string, {OUTCOME} string").format(fmt).load(path)
    by = {r[REASON]: r["n"] for r in stored.groupBy(REASON).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per reason
    bad = {f"reason {name}": by.get(name, 0) for name in reasons}
    return {"rows": sum(by.values()), ACCEPTED: by.get(None, 0), REJECTED: sum(bad.values()), **bad}


def read_routed(spark: SparkSession, path: str, outcome: str, schema: T.StructType | str, *, fmt: str = "parquet") -> DataFrame:
    """One side of a routed load; a side without rows is an empty table.
    ``schema``: that of the rows routed."""
    whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*whole.fields, T.StructField(REASON, T.StringType()), T.StructField(OUTCOME, T.StringType())])
    return spark.read.schema(whole).format(fmt).load(path).where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def report(df: DataFrame) -> dict:
    """Row count and schema of a result (an action; for job logs)."""
    return {"rows": df.count(), "schema": df.schema.simpleString()}


def reports(df: DataFrame, *by: str) -> DataFrame:
    """K10 as a table: rows and schema of each part of a result, lazily."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).withColumn("schema", F.lit(df.schema.simpleString()))
