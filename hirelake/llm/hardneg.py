"""Hard negatives by threshold joins over an inverted index with norm bounds.

Components become whole numbers, dimensions are put in order of their weight in
the table, and rows are dealt to index blocks.  A block keeps, for each row and
each segment of dimensions, the norm of what is left after it.  Anchors come
with a threshold, and a block of anchors meets every index block:

* Dimensions from the segment on where (largest rest of a row) x (largest rest
  of an anchor) is below the smallest threshold are left out of the index: a
  pair that meets only there can't reach its threshold.
* Partial scores of the dimensions kept are accumulated, and a pair goes on only
  while its score so far plus the product of the rests can reach the threshold.
* What is left is scored to the end, exactly.

Thresholds start high and are lowered for those anchors alone whose windows are
not full yet; the last threshold is the window's own end, so that results are
whole.  First an anchor's positives are found (its nearest rows of the same
label), then for each positive the nearest rows of other labels whose score lies
in the window below the positive's.

The anchors are a stated query set against all rows, in blocks: what leaves a
task for an anchor is at most its window's length.  Index blocks are dealt by a
hash of vec_id, so a label or a vector that a third of the rows share is split
like any other.

Nulls: rows with a null vec_id, label or vector, or a null or non-finite
component take no part.  Rows that share a vec_id count once, the least label,
then the least vector.  Vectors may differ in length: a missing component is 0.
Equal scores go by smaller vec_id.  Scores are exact; beyond the long range they
are held at its ends, as are components beyond 1e150.  Other columns are not looked at.  An empty table has no
negatives.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: Components are multiplied by this and cut down to whole numbers.
SCALE = 256.0
#: Numbers in an index block and in a block of anchors, and dimensions in a segment.
INDEX_CELLS, ANCHOR_CELLS, SEGMENT = 1 << 18, 1 << 15, 8
#: Most index blocks in a lane (2.4 MB each).
LANE_BLOCKS = 16
#: Thresholds of the positives, as shares of the anchor's squared norm, and of
#: the negatives, as shares of the positive's score; then the window's own end.
POSITIVE_STEPS, NEGATIVE_STEPS = (0.8, 0.45), (0.95,)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
MOST_COMPONENT = 1e150
NAMES = ["ids", "labels", "cells", "rests"]
BLOCK_SCHEMA = "block int, " + ", ".join(f"{c} binary" for c in NAMES)


# ------------------------------------------------------------------- vectors
def _usable(vec_id: str, label: str, vector: str) -> Column:
    finite = F.forall(vector, lambda x: F.abs(F.coalesce(x.cast("double"), F.lit(float("nan")))) < F.lit(float("inf")))
    return F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite


def prepared(table: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector): the rows that take part, one for a vec_id."""
    rows = table.where(_usable(vec_id, label, vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.struct(F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")


def whole(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as a matrix of whole numbers, shorter ones filled with 0."""
    values, offsets = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = np.floor(np.clip(values, -MOST_COMPONENT, MOST_COMPONENT) * SCALE)
    return out


def dimension_order(rows: DataFrame) -> list[int]:
    """Dimensions by falling sum of squares over all rows (one number for each
    dimension comes to the driver)."""
    def weigh(batches):
        for batch in batches:
            vectors = batch.column("vector")
            width = max(np.diff(vectors.offsets.to_numpy()), default=0)
            if width:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array((whole(vectors, width) ** 2).sum(0))],
                                                 names=["dimension", "weight"])

    found = rows.select("vector").mapInArrow(weigh, "dimension int, weight double").groupBy("dimension").agg(F.sum("weight").alias("w"))
    return [r.dimension for r in found.orderBy(F.desc("w"), "dimension").collect()]


def _blocks(order: list[int], extra: list[str]) -> Callable:
    """Rows gathered by block -> one row with matrices as bytes."""
    at, width = np.array(order, int), len(order)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("rows")[i].values
                cells = whole(held.field("vector"), width)[:, at]
                ends = list(range(0, width, SEGMENT)) + [width]
                squares = np.concatenate([cells ** 2, np.zeros((len(cells), 1))], 1)[:, ::-1].cumsum(1)[:, ::-1]
                rests = np.sqrt(squares[:, ends]) * (1 + 1e-9)
                kept = {c: batch.column(c).slice(i, 1) for c in ("block", *extra)}
                made = [*(held.field(c).to_numpy().astype(np.int64) for c in ("vec_id", "label")), cells, rests]
                made = dict(zip(NAMES, (pa.array([x.tobytes()], pa.binary()) for x in made), strict=True))
                yield pa.RecordBatch.from_pydict({"block": kept["block"], **made, **kept})

    return run


def _blocks_of(n: int, width: int, cells: int) -> int:
    return max(1, -(-n * max(width, 1) // cells))


def _dealt(rows: DataFrame, blocks: int, fields: list[str]) -> DataFrame:
    """Rows gathered into ``blocks`` blocks of about as many."""
    return rows.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")).agg(
        F.collect_list(F.struct(*fields)).alias("rows"))


class Index:
    """The inverted index of ``rows`` (vec_id, label, vector), written once."""

    def __init__(self, scratch: common.Scratch, rows: DataFrame):
        self.scratch, self.rows = scratch, rows
        self.order = dimension_order(rows)
        blocks = _blocks_of(rows.count(), len(self.order), INDEX_CELLS)
        # a task holds the index blocks of one lane at a time
        self.lanes = min(blocks, max(common.partitions(scratch.spark), -(-blocks // LANE_BLOCKS)))
        packed = _dealt(rows, blocks, ["vec_id", "label", "vector"])
        self.table = scratch.write(packed.mapInArrow(_blocks(self.order, []), BLOCK_SCHEMA), "index").withColumn(
            "lane", F.col("block") % self.lanes)

    def join(self, anchors: DataFrame, n: int, pick: Callable, schema: str, name: str) -> DataFrame:
        """Each block of anchors (vec_id, label, vector, windows) against
        each index block: what ``pick`` makes of the pairs that reach the
        threshold, which is the least ``low`` of an anchor's windows."""
        def meet(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in batch.schema.names}
                    x, a = _held(row, "x_"), _held(row, "a_")
                    wins = row["windows"].values
                    each = np.repeat(np.arange(len(a.ids)), np.diff(wins.offsets.to_numpy()))
                    wins = wins.flatten()
                    lows = np.full(len(a.ids), np.inf)
                    np.minimum.at(lows, each, wins.field("low").to_numpy(zero_copy_only=False))
                    found = _reaching(x, a, lows)
                    if len(found[0]) and (made := pick(x, a, each, wins, *found)) is not None:
                        yield made

        gathered = _dealt(anchors, _blocks_of(n, len(self.order), ANCHOR_CELLS), ["vec_id", "label", "vector", "windows"]).withColumn(
            "windows", F.col("rows.windows"))
        kind = gathered.schema["windows"].dataType.simpleString()
        packed = self.scratch.write(gathered.mapInArrow(_blocks(self.order, ["windows"]), f"{BLOCK_SCHEMA}, windows {kind}"), f"{name}-anchors")
        lanes = packed.select(*(F.col(c).alias(f"a_{c}") for c in NAMES), "windows",
                              F.explode(F.sequence(F.lit(0), F.lit(self.lanes - 1))).alias("lane"))
        # a merge join by hint: Spark takes the anchors' size from their file, which holds them once
        # and compressed, and would broadcast what is many times that; the index side is the one held
        pairs = lanes.hint("merge").join(self.table.select("lane", *(F.col(c).alias(f"x_{c}") for c in NAMES)), "lane").drop("lane")
        return self.scratch.write(pairs.mapInArrow(meet, schema), name)


# --------------------------------------------------------------- thresholds
class _held:
    def __init__(self, row: dict, prefix: str):
        get = lambda c, kind: np.frombuffer(row[prefix + c].as_py(), kind)
        self.ids, self.labels = get("ids", np.int64), get("labels", np.int64)
        self.cells = get("cells", np.float64).reshape(len(self.ids), -1)
        self.rests = get("rests", np.float64).reshape(len(self.ids), -1)


def _reaching(x: _held, a: _held, lows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of the pairs whose score is at least the anchor's low."""
    ends = [min(k * SEGMENT, x.cells.shape[1]) for k in range(x.rests.shape[1])]
    least = lows.min()
    met = x.rests.max(0) * a.rests.max(0)
    kept = int(np.argmax(met < least)) if (met < least).any() else len(ends) - 1
    slack = met[0] * 1e-9
    score = x.cells[:, :ends[kept]] @ a.cells[:, :ends[kept]].T

    def alive(k):
        return score + np.multiply.outer(x.rests[:, k], a.rests[:, k]) >= lows - slack

    live = alive(kept)
    while kept < len(ends) - 1 and live.mean() > 0.05:  # many are left: go on with all
        kept += 1
        score += x.cells[:, ends[kept - 1]:ends[kept]] @ a.cells[:, ends[kept - 1]:ends[kept]].T
        live = alive(kept)
    i, j = np.nonzero(live)
    score = score[i, j]
    for k in range(kept + 1, len(ends)):
        part = slice(ends[k - 1], ends[k])
        score = score + (x.cells[i, part] * a.cells[j, part]).sum(1)
        on = score + x.rests[i, k] * a.rests[j, k] >= lows[j] - slack
        i, j, score = i[on], j[on], score[on]
    if met[0] < 2 ** 53:  # all sums so far are exact
        exact = score.astype(np.int64)
    else:
        exact = np.array([min(MOST, max(LEAST, sum(int(p) * int(q) for p, q in zip(x.cells[r], a.cells[s], strict=True))))
                          for r, s in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    on = exact >= lows[j] - slack
    return i[on], j[on], exact[on]


def _nearest(group: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest scores of each group, ties to smaller ids."""
    at = np.lexsort((ids, ~score, group))
    group = group[at]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
    return at[rank < most]


def _positives(most: int) -> Callable:
    def pick(x, a, each, wins, i, j, score):
        same = (x.labels[i] == a.labels[j]) & (x.ids[i] != a.ids[j])
        i, j, score = i[same], j[same], score[same]
        at = _nearest(j, score, x.ids[i], most)
        return pa.RecordBatch.from_arrays([pa.array(a.ids[j[at]]), pa.array(x.ids[i[at]]), pa.array(score[at])],
                                          names=["anchor_id", "positive_id", "positive_score"]) if len(at) else None

    return pick


def _negatives(most: int) -> Callable:
    def pick(x, a, each, wins, i, j, score):
        other = x.labels[i] != a.labels[j]
        i, j, score = i[other], j[other], score[other]
        low, high = (wins.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
        ids = wins.field("id").to_numpy(zero_copy_only=False)
        # pairs times the windows of their anchor
        first, size = np.searchsorted(each, j), np.bincount(each, minlength=len(a.ids))[j]
        pair = np.repeat(np.arange(len(j)), size)
        window = np.repeat(first, size) + np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        inside = (score[pair] >= low[window]) & (score[pair] <= high[window])
        pair, window = pair[inside], window[inside]
        at = _nearest(window, score[pair], x.ids[i[pair]], most)
        pair, window = pair[at], window[at]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (a.ids[j[pair]], ids[window], high[window], x.ids[i[pair]], score[pair])],
            names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]) if len(at) else None

    return pick


def _first(rows: DataFrame, keys: list[str], score: str, vec_id: str, most: int) -> DataFrame:
    """The ``most`` nearest of each key with their rank: there are at most that
    many from each index block."""
    from pyspark.sql.window import Window

    window = Window.partitionBy(*keys).orderBy(F.desc(score), vec_id)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)


# ----------------------------------------------------------------- the whole
def mine(table: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 5, floor: tuple[int, int] = (4, 5)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows of ``table`` (vec_id, label, embedding) that
    meet ``anchors`` (a condition on vec_id).  A negative's score is at most its
    positive's and at least ``floor`` (a fraction) of it."""
    scratch = common.Scratch(table.sparkSession, "hardneg")
    rows = scratch.write(prepared(table), "rows")
    index = Index(scratch, rows)
    asked = scratch.write(rows.where(anchors).withColumn(
        "norm", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * SCALE * x * SCALE)), "asked")

    # positives: the threshold falls until as many rows as asked for reach it
    open_, found = asked, None
    for k, share in enumerate([*POSITIVE_STEPS, None]):
        if not (n := open_.count()):
            break
        low = F.lit(float("-inf")) if share is None else F.col("norm") * share
        given = open_.withColumn("windows", F.array(F.struct(low.alias("low"))))
        near = index.join(given, n, _positives(positives), "anchor_id long, positive_id long, positive_score long", f"positives-{k}")
        best = _first(near, ["anchor_id"], "positive_score", "positive_id", positives)
        full = best.where(F.col("rank") == positives).select(F.col("anchor_id").alias("vec_id"))
        done = best if share is None else best.join(full.withColumnRenamed("vec_id", "anchor_id"), "anchor_id", "left_semi")
        done = scratch.write(done.drop("rank"), f"positives-done-{k}")
        found = done if found is None else found.unionByName(done)
        open_ = scratch.write(open_.join(full, "vec_id", "left_anti"), f"open-{k}") if share is not None else open_
    if found is None:
        return _no_negatives(rows)

    # negatives: a window a positive, its lower end falls until the window is full
    num, den = floor
    p = F.col("positive_score").cast("decimal(38,0)")
    end = F.greatest(F.ceil(p * num / den).cast("decimal(38,0)"), F.lit(LEAST).cast("decimal(38,0)")).cast("long")
    windows = scratch.write(found.where("positive_score >= 0").withColumn("end", end), "windows")
    out = None
    for k, share in enumerate([*NEGATIVE_STEPS, None]):
        low = F.col("end") if share is None else F.greatest("end", F.ceil(F.col("positive_score") * share).cast("long"))
        by = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(
            F.struct(low.alias("low"), F.col("positive_score").alias("high"), F.col("positive_id").alias("id"))).alias("windows"))
        given = scratch.write(asked.join(by, "vec_id"), f"asked-{k}")
        if not (n := given.count()):
            break
        keys = ["anchor_id", "positive_id"]
        near = index.join(given, n, _negatives(negatives),
                          "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", f"negatives-{k}")
        best = _first(near, keys, "negative_score", "negative_id", negatives)
        full = best.where(F.col("rank") == negatives).select(*keys)
        done = scratch.write(best if share is None else best.join(full, keys, "left_semi"), f"negatives-done-{k}")
        out = done if out is None else out.unionByName(done)
        windows = scratch.write(windows.join(full, keys, "left_anti"), f"windows-{k + 1}") if share is not None else windows
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return _no_negatives(rows) if out is None else out.select(*columns)


def _no_negatives(rows: DataFrame) -> DataFrame:
    none = F.lit(0).cast("long")
    return rows.where(F.lit(False)).select(none.alias("anchor_id"), none.alias("positive_id"), F.lit(0).alias("rank"), none.alias("negative_id"),
                                           none.alias("positive_score"), none.alias("negative_score"))


def relabelled(table: DataFrame) -> DataFrame:
    """Every seventh vec_id gets the next of ten labels."""
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(F.col("label").cast("long"))
    return table.withColumn("label", moved)
