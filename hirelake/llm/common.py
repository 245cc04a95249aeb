"""What the operators share: scratch tables, folds, prefix sums, components.

Scratch tables are written below ``spark.checkpoint.dir`` (the folder that all
executors share), so a lost executor costs a re-read, never a result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: In force while a scratch table is written: its shuffle files go when the
#: job ends (all later steps read the table), and Arrow batches stay small.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local folder only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """Tables of one run of an operator, in a new folder of the shared one."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{operator}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        before = {k: self.spark.conf.get(k, None) for k in WRITING}
        try:
            for k, v in WRITING.items():
                self.spark.conf.set(k, v)
            df.write.option("compression", "zstd").parquet(self.path(name))
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null for a null key)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def in_fold(key: str, folds: int, number: int) -> Column:
    """Whether the row is of the held-out fold; a null key is in none."""
    return F.coalesce(fold(key, folds) == number, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches where the texts reach ``most`` bytes (one row at
    least), which bounds what a task holds at a time."""
    for batch in batches:
        offsets, start = batch.column(column), 0
        sizes = pc.fill_null(pc.binary_length(offsets), 0).to_numpy(zero_copy_only=False)
        total = 0
        for i, size in enumerate(sizes.tolist()):
            if total + size > most and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)


def text_or_empty(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column), "")


def prefix_sums(scratch: Scratch, rows: DataFrame, order: list[str], value: str, name: str,
                group: str | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows ahead in ``order``
    (within ``group``, which then leads the order).

    Rows are range-partitioned; each task adds up its own part, and the totals
    of the parts (one row for a part and group, so as many as there are parts
    and groups) give each part its base."""
    spark = rows.sparkSession
    keys = ([group] if group else []) + order
    at = rows.schema.fieldNames()

    def local(batches):
        part, total, held = TaskContext.get().partitionId(), 0, ()
        for batch in batches:
            values = batch.column(value).to_pylist()
            groups = batch.column(group).to_pylist() if group else [None] * len(values)
            before = []
            for g, v in zip(groups, values, strict=True):
                if (g,) != held:
                    held, total = (g,), 0
                before.append(total)
                total += v
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(values), pa.int32()), pa.array(before, pa.int64())],
                names=[*at, "part", "part_before"])

    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("part int, part_before long")])
    ranged = rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    ranged = scratch.write(ranged.mapInArrow(local, schema), name)
    by = [group] if group else []
    totals = ranged.groupBy("part", *by).agg(F.sum(value).alias("part_total"))
    window = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("part").alias("of_part"), *(F.col(g).alias("of_group") for g in by),
                          F.coalesce(F.sum("part_total").over(window), F.lit(0)).alias("base"))
    match = F.col("part") == F.col("of_part")
    if group:
        match &= F.col(group).eqNullSafe(F.col("of_group"))
    # one row for a part (and group): bounded by the number of partitions
    return (ranged.join(F.broadcast(bases), match)
            .select(*at, (F.col("part_before") + F.col("base")).alias("before")))


def components(scratch: Scratch, edges: DataFrame, name: str, rounds: int = 40) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b),
    for every node that has an edge.

    Large-star and small-star steps in turn (Kiveris and others, 2014), each a
    group-by and a join on narrow rows, written after each round."""
    spark = edges.sparkSession
    current = scratch.write(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v").distinct(), f"{name}-0")
    for i in range(1, rounds + 1):
        # large star: larger neighbours take the smallest of the neighbourhood
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: a node and its smaller neighbours take the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u")
        stars = (small.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(least.select("u", F.col("low").alias("v"))).distinct())
        after = scratch.write(stars, f"{name}-{i}")
        done = (current.count() == after.count()
                and after.join(current, ["u", "v"], "left_anti").limit(1).count() == 0)
        scratch.drop(f"{name}-{i - 1}")
        current = after
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
