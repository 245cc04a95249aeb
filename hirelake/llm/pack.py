"""Packing along a space-filling curve.

A document's token ids make a hashed vector (buckets of ids, the rarer the id
the heavier), which a fixed random matrix projects to a few dimensions.  The
Hilbert key of that point orders the documents; running totals of tokens along
the order (range-partitioned, one total per part) place each document, and it
is cut where a sequence is full.  So all sequences but the last are full, and
neighbours on the curve share sequences.  With target weights of sources the
curve is followed within windows of consecutive slots of the mixture
(``mixing``), one window after the other, so that the sequences in order keep
to the target shares; the slots follow from the rows alone and are worked out
on narrow ones.

Nulls: a null text is empty (its end id alone); a null doc_id is a document
like others.  Repeated rows are packed once each.  Ties on the curve go by
doc_id.  Other columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common, encode, mixing

BUCKETS, DIMENSIONS, BITS, SEED = 256, 4, 12, 11
DRAWN = "class string, draw long, size long"


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of integer points (rows of ``grid``),
    by Skilling's transposed form (2004)."""
    axes = [grid[:, i].astype(np.uint64) for i in range(grid.shape[1])]
    one, n = np.uint64(1), len(axes)
    for b in range(bits - 1, 0, -1):
        bit, below = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(n):
            high = (axes[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (axes[0] ^ axes[i]) & below)
            axes[0] = np.where(high, axes[0] ^ below, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, n):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for b in range(bits - 1, 0, -1):
        bit = one << np.uint64(b)
        turn = np.where((axes[-1] & bit) != 0, turn ^ (bit - one), turn)
    key = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << one) | (((a ^ turn) >> np.uint64(b)) & one)
    return key


class Curve:
    """Hilbert keys of documents given by their token ids."""

    def __init__(self, vocabulary: int, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, bits: int = BITS):
        draw = np.random.default_rng(SEED)
        self.bucket = draw.integers(0, buckets, vocabulary)
        self.sign = draw.choice([-1.0, 1.0], vocabulary) * np.log1p(np.arange(vocabulary))
        self.matrix = draw.standard_normal((buckets, dimensions))
        self.buckets, self.bits = buckets, bits

    def keys(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        document = np.repeat(np.arange(n), np.diff(offsets))
        vectors = np.bincount(document * self.buckets + self.bucket[ids], self.sign[ids], n * self.buckets)
        vectors = vectors.reshape(n, self.buckets)
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        points = (vectors / np.where(length > 0, length, 1)) @ self.matrix
        cells = (0.5 + 0.5 * np.tanh(points)) * (1 << self.bits)
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.uint64), self.bits).astype(np.int64)


def encoded(docs: DataFrame, tokenizer: str, end: int, weights: dict[str, float] | None = None) -> DataFrame:
    """(row, doc_id, curve, n_tokens, ids): ids as little-endian 16-bit
    integers, 32-bit ones where the vocabulary needs them; with ``weights``
    the columns of ``mixing.drawn`` too."""
    extra = ["class", "draw", "size"] if weights else []

    def run(batches):
        encoder = encode.encoder(tokenizer)
        curve = Curve(max(len(encoder.ends), end + 1))
        kind = "<u2" if max(len(encoder.ends), end + 1) <= 1 << 16 else "<u4"
        row = TaskContext.get().partitionId() << 33
        for batch in common.slices(batches, "text"):
            ids, offsets = encode.with_end(*encoder.encode(common.text_or_empty(batch)), end)
            data = ids.astype(kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + batch.num_rows)), batch.column("doc_id"),
                pa.array(curve.keys(ids, offsets)), pa.array(np.diff(offsets)),
                pa.array([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()),
                *(batch.column(c) for c in extra),
            ], names=["row", "doc_id", "curve", "n_tokens", "ids", *extra])
            row += batch.num_rows

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *(mixing.drawn(weights, mixing.SEED) if weights else []))
    return kept.mapInArrow(run, ", ".join(["row long, doc_id long, curve long, n_tokens long, ids binary", *([DRAWN] if weights else [])]))


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = 4096, end: int = 2,
         weights: dict[str, float] | None = None, block: int = mixing.BLOCK, window: int = 100) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset
    and ids (the piece's ids as little-endian unsigned 32-bit integers).  With
    ``weights`` (of all classes, see ``mixing.shares``) the curve is followed
    within each ``window`` slots of ``block`` characters."""
    tokenizer = tokenizer or encode.default_tokenizer()
    scratch = common.Scratch(docs.sparkSession, "pack")
    rows = scratch.write(encoded(docs, tokenizer, end, weights), "rows")
    narrow, order = rows.drop("ids"), ["curve", "doc_id", "row"]
    if weights:
        slots = mixing.place(scratch, narrow, weights, block, mixing.RESOLUTION)
        narrow = slots.select("row", "doc_id", "curve", "n_tokens", F.floor(F.col("slot") / window).alias("window"))
        order = ["window", *order]
    places = common.prefix_sums(scratch, narrow, order, "n_tokens", "places").select("row", "before")

    names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")

    def cut(batches):
        for batch in batches:
            out = {k: [] for k in names}
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids", "before"))
            for doc, n, data, before in zip(*columns, strict=True):
                ids = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
                at = 0
                while at < n:
                    sequence, offset = divmod(before + at, length)
                    size = min(n - at, length - offset)
                    piece = (doc, at, size, n, sequence, offset, ids[at:at + size].tobytes())
                    for k, v in zip(names, piece, strict=True):
                        out[k].append(v)
                    at += size
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[k], pa.binary() if k == "ids" else pa.int64()) for k in names], names=list(names))

    schema = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return rows.join(places, "row").select("doc_id", "n_tokens", "ids", "before").mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, ids): the packed sequences themselves, ids as in
    the pieces; a group is one sequence, so bounded by its length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return (pieces.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), joined.alias("ids")))
