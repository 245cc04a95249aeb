"""Token ids as a keyed binary store.

A store is a folder of three tables.
``payload``: records in ascending doc_id order (shard, record), each the raw
little-endian ids of whole documents one after another, about 256 KB.
``shards``: the ids ahead of each shard.
``index``: buckets of a hash of the key, each with a minimal perfect hash of
its keys (levels of bits: a key stands at its first position that no other key
of that level shares; Limasset and others, 2017).  Its rank among the set bits
is the key's slot, where the store keeps a fingerprint of the key and shard,
record, start and length.  So a look-up takes one index row and one record,
however large the store.

A key is (doc_id, occurrence): rows that repeat a doc_id are occurrences 0, 1
and so on, in the order of a hash of their texts; a null doc_id is a key like
others and comes first.  A null text is empty (its end id alone).  Other
columns are ignored.  An empty table makes a store without rows.  A key that
the store lacks is not found (null length), save for a chance of 2**-32.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelake.llm import common, encode
from hirelake.llm.words import spread

RECORD_BYTES, BUCKET_KEYS, GAMMA = 256 << 10, 4096, 2
#: One-to-one for the first occurrence of any doc_id, as xxhash64 of one long is.
KEY_HASH = ("case when doc_id is not null and occurrence = 0 then xxhash64(doc_id) "
            "else xxhash64(doc_id is null, coalesce(doc_id, 0), occurrence) end")
SLOTS = (("fingerprint", "<u4"), ("shard", "<i4"), ("record", "<i4"), ("start", "<i8"), ("length", "<i8"))


def level_positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (spread(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (spread(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Bits of each level for distinct 64-bit keys."""
    levels = []
    while len(keys):
        if len(levels) == 64:
            raise ValueError("two keys of the store have the same 64-bit hash")
        size = max(GAMMA * len(keys), 8)
        at = level_positions(keys, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    return levels


def slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Slot of each key (-1: in no level, so not in the store)."""
    out, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
    for i, bits in enumerate(levels):
        at = level_positions(keys[left], i, len(bits))
        hit = bits[at]
        out[left[hit]] = base + np.cumsum(bits)[at[hit]] - 1
        base, left = base + int(bits.sum()), left[~hit]
    return out


def encoded(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """(doc_id, text_hash, n_tokens, ids) of every whole text as it is read: ids
    as little-endian 16-bit integers, 32-bit ones where the vocabulary needs them."""

    def run(batches):
        encoder = encode.encoder(tokenizer)
        kind = "<u2" if max(len(encoder.ends), end + 1) <= 1 << 16 else "<u4"
        for batch in common.slices(batches, "text"):
            ids, offsets = encode.with_end(*encoder.encode(common.text_or_empty(batch)), end)
            data = ids.astype(kind)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(offsets)),
                pa.array([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()),
            ], names=["doc_id", "text_hash", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, n_tokens long, ids binary"))


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = 1) -> None:
    """Encode every whole text and write the store to ``folder``.

    Texts are encoded as they are read, and only their ids are shuffled and
    sorted, so no task holds sort memory and the encoder's words at once."""
    spark, tokenizer = docs.sparkSession, tokenizer or encode.default_tokenizer()

    def records(batches):
        encode.encoder.cache_clear()  # workers that encoded are used again: their words go
        shard, record, ahead, held, last, count = TaskContext.get().partitionId(), 0, 0, [], None, 0

        def flush():
            ids, occurrences, sizes, data = map(list, zip(*held, strict=True))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            row = {"shard": [shard], "record": [record], "ahead": [ahead], "n_tokens": [sum(sizes)],
                   "doc_ids": [ids], "occurrences": [occurrences], "starts": [starts.tolist()],
                   "lengths": [sizes], "ids": [b"".join(data)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([
                ("shard", pa.int32()), ("record", pa.int32()), ("ahead", pa.int64()), ("n_tokens", pa.int64()),
                *((k, pa.list_(pa.int64())) for k in ("doc_ids", "occurrences", "starts", "lengths")), ("ids", pa.binary())]))

        size = 0
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("doc_id", "n_tokens"))
            for key, n, data in zip(*columns, batch.column("ids"), strict=True):
                count = count + 1 if (key,) == last else 0
                last = (key,)
                held.append((key, count, n, data.as_py()))
                size += len(held[-1][3])
                if size >= RECORD_BYTES:
                    out = flush()
                    yield out
                    record, ahead, held, size = record + 1, ahead + out.column("n_tokens")[0].as_py(), [], 0
        if held:
            yield flush()

    payload_schema = ("shard int, record int, ahead long, n_tokens long, doc_ids array<long>, occurrences array<long>, "
                      "starts array<long>, lengths array<long>, ids binary")
    scratch = common.Scratch(spark, "idstore")
    scratch.root = folder
    rows = (scratch.write(encoded(docs, tokenizer, end), "encoded")
            .repartitionByRange(common.partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text_hash", "ids"))
    payload = scratch.write(rows.mapInArrow(records, payload_schema), "payload")
    scratch.drop("encoded")

    totals = payload.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    ahead = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    scratch.write(totals.select("shard", F.coalesce(ahead, F.lit(0)).alias("base"), "n_tokens"), "shards")

    entries = (payload.select("shard", "record", F.explode(F.arrays_zip("doc_ids", "occurrences", "starts", "lengths")).alias("e"))
               .select("shard", "record", F.col("e.doc_ids").alias("doc_id"), F.col("e.occurrences").alias("occurrence"),
                       F.col("e.starts").alias("start"), F.col("e.lengths").alias("length"))
               .withColumn("key", F.expr(KEY_HASH)))
    n_buckets = max(1, -(-payload.agg(F.sum(F.size("doc_ids"))).first()[0] // BUCKET_KEYS)) if payload.take(1) else 1

    def index(batches):
        for batch in batches:
            out = {k: [] for k in ("bucket", "buckets", "levels", *(k for k, _ in SLOTS))}
            for bucket, members in zip(batch.column("bucket").to_pylist(), batch.column("entries"), strict=True):
                entry = members.values
                keys = entry.field("key").to_numpy().view(np.uint64)
                levels = build_hash(keys)
                at = slots(levels, keys)
                out["bucket"].append(bucket)
                out["buckets"].append(n_buckets)
                out["levels"].append([np.packbits(x).tobytes() + len(x).to_bytes(4, "little") for x in levels])
                for name, kind in SLOTS:
                    values = fingerprints(keys) if name == "fingerprint" else entry.field(name).to_numpy()
                    placed = np.empty(len(keys), kind)
                    placed[at] = values
                    out[name].append(placed.tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("bucket", pa.int64()), ("buckets", pa.int64()), ("levels", pa.list_(pa.binary())),
                *((k, pa.binary()) for k, _ in SLOTS)]))

    # a bucket holds about BUCKET_KEYS keys, as the keys are distinct and hashed
    grouped = (entries.withColumn("bucket", F.expr(f"pmod(key, {n_buckets}L)")).groupBy("bucket")
               .agg(F.collect_list(F.struct("key", "shard", "record", "start", "length")).alias("entries")))
    index_schema = "bucket long, buckets long, levels array<binary>, " + ", ".join(f"{k} binary" for k, _ in SLOTS)
    scratch.write(grouped.mapInArrow(index, index_schema), "index")


def locate(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Where the store has each distinct (doc_id, occurrence) of ``keys``."""
    index = spark.read.parquet(f"{folder}/index")
    n_buckets = (index.select("buckets").take(1) or [[1]])[0][0]
    wanted = (keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("occurrence").cast("long").alias("occurrence"))
              .distinct().withColumn("key", F.expr(KEY_HASH)).withColumn("bucket", F.expr(f"pmod(key, {n_buckets}L)"))
              .groupBy("bucket").agg(F.collect_list(F.struct("key", "doc_id", "occurrence")).alias("wanted")))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                want = batch.column("wanted")[i].values
                keys = want.field("key").to_numpy().view(np.uint64)
                levels = []
                for data in batch.column("levels")[i].as_py() or ():
                    levels.append(np.unpackbits(np.frombuffer(data[:-4], np.uint8), count=int.from_bytes(data[-4:], "little")).astype(bool))
                at = slots(levels, keys)
                data = {k: np.frombuffer(batch.column(k)[i].as_py() or b"", kind) for k, kind in SLOTS}
                found = at >= 0
                found[found] = data["fingerprint"][at[found]] == fingerprints(keys[found])
                at = np.where(found, at, 0)
                columns = [want.field("doc_id"), want.field("occurrence")]
                for name, kind in SLOTS[1:]:
                    values = data[name][at] if len(data[name]) else np.zeros(len(at), kind)
                    columns.append(pa.array(values.astype(kind[1:]), mask=~found))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "occurrence", *(k for k, _ in SLOTS[1:])])

    return (wanted.join(index.drop("buckets"), "bucket", "left")
            .mapInArrow(run, "doc_id long, occurrence long, shard int, record int, start long, length long"))


def fetch(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """(doc_id, occurrence, start, n_tokens, ids) of the keys that the store
    has: start counts the ids of all documents before, ids are little-endian
    unsigned 32-bit integers.  One record's keys are one row (a record is
    bounded), so each record is read once."""
    payload, shards = spark.read.parquet(f"{folder}/payload"), spark.read.parquet(f"{folder}/shards")
    asked = (locate(spark, folder, keys).where("length is not null").groupBy("shard", "record")
             .agg(F.collect_list(F.struct("doc_id", "occurrence", "start", "length")).alias("asked")))
    # one row for a shard: bounded by the number of partitions that wrote
    rows = (payload.select("shard", "record", "ahead", "n_tokens", "ids").join(asked, ["shard", "record"])
            .join(F.broadcast(shards.select("shard", "base")), "shard"))

    def run(batches):
        names = ["doc_id", "occurrence", "start", "n_tokens", "ids"]
        for batch in batches:
            for i in range(batch.num_rows):
                data, total = batch.column("ids")[i].as_py(), batch.column("n_tokens")[i].as_py()
                ids = np.frombuffer(data, f"<u{len(data) // total}").astype("<u4")
                ahead = batch.column("ahead")[i].as_py() + batch.column("base")[i].as_py()
                asked = batch.column("asked")[i].values
                starts, sizes = asked.field("start").to_numpy(), asked.field("length").to_numpy()
                yield pa.RecordBatch.from_arrays([
                    asked.field("doc_id"), asked.field("occurrence"), pa.array(starts + ahead), pa.array(sizes),
                    pa.array([ids[a:a + n].tobytes() for a, n in zip(starts, sizes, strict=True)], pa.binary())], names=names)

    return rows.mapInArrow(run, "doc_id long, occurrence long, start long, n_tokens long, ids binary")
