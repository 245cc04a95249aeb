"""Tables that grow by batches and can be loaded again safely (K2, K3, K4, K6).

A batch is written to a folder of its own below ``data``; it becomes part of the
table when its entry appears below ``manifest``, by a rename that fails if the
entry is there.  So

* a batch that was committed is not loaded again,
* a load that was killed leaves a folder that no entry names: nothing reads it,
  and the next attempt writes another one,
* of two attempts at a time one commits.

``key`` makes the load a keyed merge as well: a row whose key the table (or an
earlier row of the batch) has is not appended, whatever batch it came with.  The
probe reads the key column only, and only the partitions that the batch has rows
in.  ``replaces`` lets one entry take the place of others (corrected batches,
compaction) in the same atomic step.

Readers name the committed folders and the stored schema, so no table is listed
whole and no schema is inferred.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sinks


#: Folders of batches are partitions of this name, so that many are read as one table.
LOAD = "load"


class BatchTable:
    """The table below ``path``; ``partition_by``: its partition columns."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    # ------------------------------------------------------------- manifest
    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def entries(self) -> list[dict]:
        """The manifest's entries in force, by batch: one small file per batch."""
        fs, folder = self._fs(), self._at("manifest")
        if not fs.exists(folder):
            return []
        found = {}
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith((".", "_")):
                continue
            stream = fs.open(status.getPath())
            try:
                entry = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            found[entry["batch"]] = entry
        gone = {b for e in found.values() for b in e["replaces"]}
        return [e for b, e in sorted(found.items()) if b not in gone]

    def batches(self) -> list[str]:
        return [e["batch"] for e in self.entries()]

    def has(self, batch: str) -> bool:
        """Whether the batch was ever committed (also if it was replaced since)."""
        return self._fs().exists(self._at("manifest", f"{batch}.json"))

    def _commit(self, entry: dict) -> bool:
        """Put the entry into the manifest; False if there is one of this batch."""
        jvm, fs = self.spark._jvm, self._fs()
        fs.mkdirs(self._at("manifest"))
        text = json.dumps(entry)
        written = self._at("manifest", f".{entry['batch']}-{uuid.uuid4().hex}")
        stream = fs.create(written, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.makeQualified(written).toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(written), fs.makeQualified(self._at("manifest", f"{entry['batch']}.json")), none)
        except Py4JJavaError as e:
            fs.delete(written, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    # ----------------------------------------------------------------- load
    def _unseen(self, df: DataFrame, key: str, order: Column | None) -> DataFrame:
        """Rows whose key neither the table nor an earlier row of the batch has
        (rows of one key: the least ``order``); a NULL key equals another."""
        keys = df.select(F.col(key).alias("_known"))
        again = keys.groupBy("_known").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_known")
        same_key = F.col(key).eqNullSafe(F.col("_known"))
        stored = self.read()
        if stored is not None and self.partition_by:
            # the partitions of one batch: bounded by how many it writes
            where = F.lit(False)
            for row in df.select(*self.partition_by).distinct().collect():
                same = F.lit(True)
                for c in self.partition_by:
                    same &= F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c])
                where |= same
            stored = stored.where(where)
        known = None if stored is None else stored.select(F.col(key).alias("_known"))

        def without(rows: DataFrame, gone: DataFrame | None) -> DataFrame:
            return rows if gone is None else rows.join(gone, same_key, "left_anti")

        # most batches repeat no key: their rows are neither ordered nor grouped
        if again.isEmpty():
            return without(df, known)
        rest = [c for c in df.columns if c != key]
        packed = F.struct(*rest)
        first = F.any_value(packed) if order is None else F.min_by(packed, order)
        one = (without(df.join(again, same_key, "left_semi"), known).groupBy(key).agg(first.alias("_row"))
               .select(key, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*df.columns))
        return without(df, again if known is None else again.unionByName(known)).unionByName(one)

    def append(self, batch: str, df: DataFrame, *, key: str | None = None, order: Column | None = None,
               replaces: Sequence[str] = ()) -> bool:
        """Load a batch; False if it was committed before (nothing is read then)."""
        if self.has(batch):
            return False
        rows = df if key is None else self._unseen(df, key, order)
        folder = uuid.uuid4().hex
        at = f"{self.path}/data/{LOAD}={folder}"
        sinks.write_table(rows, at, partition_by=self.partition_by or None)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        n = self.spark.read.schema(schema).parquet(at).count()  # from the files' footers
        return self._commit({"batch": batch, "folder": folder, "rows": n, "replaces": list(replaces), "schema": schema.jsonValue()})

    def compact(self, batch: str, df: DataFrame) -> bool:
        """Put ``df`` in the place of all batches committed so far."""
        return self.append(batch, df, replaces=self.batches())

    # ----------------------------------------------------------------- read
    def read(self, batches: Sequence[str] | None = None) -> DataFrame | None:
        """The committed rows (of some batches), or None before the first."""
        entries = [e for e in self.entries() if batches is None or e["batch"] in batches]
        if not entries:
            return None
        schema = T.StructType.fromJson(entries[0]["schema"])
        names = schema.fieldNames()
        for e in entries[1:]:  # a column that a later batch brought
            for f in T.StructType.fromJson(e["schema"]):
                if f.name not in names:
                    schema, names = schema.add(f), [*names, f.name]
        reader = self.spark.read.schema(schema.add(LOAD, "string")).option("basePath", f"{self.path}/data")
        return reader.parquet(*(f"{self.path}/data/{LOAD}={e['folder']}" for e in entries)).select(*names)

    def rows(self) -> int:
        """Rows committed, from the manifest alone."""
        return sum(e["rows"] for e in self.entries())
