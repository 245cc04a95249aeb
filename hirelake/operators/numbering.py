"""Global numbering by key order without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` makes Spark move every row into one task.
Here the keys are range-partitioned (balanced by sampling), sorted inside
each partition and tagged with ``monotonically_increasing_id`` (partition id
in the upper bits, position in the lower 33 bits).  The per-partition counts
(one row per partition) give each partition its offset by a running sum.
The tagged keys are checkpointed to the reliable checkpoint folder, so the
counts and the rows come from the same materialised partitions even if
executors are lost and tasks re-run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def number_by_key(df: DataFrame, key: str, out: str = "row_number", *,
                  distinct: bool = True, partitions: int | None = None) -> DataFrame:
    """(key, out): 1-based position of each key in ascending key order.

    ``distinct=True`` numbers each distinct non-NULL key once (dense);
    ``distinct=False`` numbers every row, so a repeated key gets several
    numbers (the behaviour of numbering before DISTINCT).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(key).where(F.col(key).isNotNull())
    if distinct:
        keys = keys.distinct()
    tagged = (keys.repartitionByRange(n, key)
              .sortWithinPartitions(key)
              .withColumn("_mid", F.monotonically_increasing_id())
              .select(key,
                      F.shiftright("_mid", 33).alias("_part"),
                      F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_pos"))
              .checkpoint(eager=True))
    # One row per partition: a proven bound, so the window and the broadcast are cheap.
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
            .select(key, (F.col("_off") + F.col("_pos") + 1).cast("bigint").alias(out)))


def _parts(df: DataFrame, order: list, partitions: int | None) -> DataFrame:
    """``df`` with _part and _pos: its range partition in ``order`` and its place
    there (checkpointed: both stay the same if tasks are run again)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_mid", F.monotonically_increasing_id())
            .withColumns({"_part": F.shiftright("_mid", 33), "_pos": F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))})
            .drop("_mid").checkpoint(eager=True))


def _with_offsets(tagged: DataFrame, total: Column) -> DataFrame:
    """``_off``: the totals of the partitions ahead (one row for a partition)."""
    sums = tagged.groupBy("_part").agg(total.alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    return tagged.join(F.broadcast(offsets), "_part")


def number_rows(df: DataFrame, order: list, out: str = "row_number", *, partitions: int | None = None) -> DataFrame:
    """1-based place of every row in ``order``, without a single-partition window."""
    tagged = _with_offsets(_parts(df, order, partitions), F.count(F.lit(1)))
    return tagged.withColumn(out, (F.col("_off") + F.col("_pos") + 1).cast("int")).drop("_part", "_pos", "_off")


def sum_before(df: DataFrame, order: list, value: str, out: str, *, partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` over the rows ahead in ``order``: running sums within
    range partitions (each no larger than a task's share), plus the totals of
    the partitions ahead."""
    tagged = _with_offsets(_parts(df, order, partitions), F.sum(value))
    ahead = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn(out, F.coalesce("_off", F.lit(0)) + F.coalesce(F.sum(value).over(ahead), F.lit(0)))
            .drop("_part", "_pos", "_off"))
