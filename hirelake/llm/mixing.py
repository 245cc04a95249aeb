"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a seeded order, make blocks of equal size (in
characters of text).  Block j of a source with weight w is released at slot
floor((j - 1) / w) and due at ceil(j / w); earliest-deadline-first over the
released blocks gives every block its slot within its window, so at any slot
each source is less than one block from its target share.

Weights are whole numbers of a resolution, so the schedule repeats: one period
is laid out by itself (its size is a parameter), and a block's slot follows
from its number.  Where a source runs out, a new phase begins with the weights
of the remaining ones in proportion; there are at most as many phases as
weights.  Everything stays: only the order is decided.  Sources without a
weight of their own share one.

Nulls: a null source is one without a weight; a null text counts one character,
as an empty one does; a null doc_id is ordered by hash like others.  Repeated
rows stay, next to each other.  Long documents span several blocks and stand at
the slot of their first.  All columns of the input pass through inside ``row``.
An empty table stays empty.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

OTHERS = "others"
BLOCK, RESOLUTION, SEED = 1 << 16, 1000, 7


def quotas(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Whole numbers that add up to ``resolution``, by largest remainder, at
    least 1 each."""
    total = sum(weights.values())
    exact = {k: w * resolution / total for k, w in weights.items()}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: int(exact[k]) - exact[k]):
        if sum(out.values()) < resolution:
            out[k] += 1
    while sum(out.values()) > resolution:
        out[max(out, key=out.get)] -= 1
    return out


def period(quota: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks within one period, by earliest deadline
    first among released blocks."""
    size, waiting, released = sum(quota.values()), [], []
    slots = {k: [] for k in quota}
    for rank, (k, q) in enumerate(quota.items()):
        waiting.append((0, rank, k, 1, q))
    heapq.heapify(waiting)
    for slot in range(size):
        while waiting and waiting[0][0] <= slot:
            _, rank, k, j, q = heapq.heappop(waiting)
            heapq.heappush(released, (-(-j * size // q), rank, k, j, q))
        _, rank, k, j, q = heapq.heappop(released)
        slots[k].append(slot)
        if j < q:
            heapq.heappush(waiting, (j * size // q, rank, k, j + 1, q))
    return slots


def phases(weights: dict[str, float], blocks: dict[str, int], resolution: int) -> list[dict]:
    """For each phase and source: the first block and first slot of the phase,
    the period's size and the source's slots within it."""
    done, slot, out = dict.fromkeys(blocks, 0), 0, []
    while left := {k: blocks[k] - done[k] for k in blocks if blocks[k] > done[k]}:
        share = {k: weights[k] for k in weights if k in left}
        slots = period(quotas(share, max(resolution, len(share))))
        size = sum(map(len, slots.values()))
        last = {k: (n - 1) // len(slots[k]) * size + slots[k][(n - 1) % len(slots[k])] for k, n in left.items()}
        length = min(last.values()) + 1  # up to the first source's last block
        for k in left:
            rounds, rest = divmod(length, size)
            taken = rounds * len(slots[k]) + sum(s < rest for s in slots[k])
            out.append({"class": k, "first_block": done[k], "end_block": done[k] + taken, "first_slot": slot, "size": size,
                        "slots": slots[k]})
            done[k] += taken
        slot += length
    return out


def drawn(weights: dict[str, float], seed: int) -> list[Column]:
    """class, draw and size of a document, from its source, doc_id and text."""
    named = [k for k in weights if k != OTHERS]
    size = F.greatest(F.coalesce(F.length("text"), F.lit(1)), F.lit(1)).cast("long")
    return [F.when(F.col("source").isin(named), F.col("source")).otherwise(OTHERS).alias("class"),
            F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw"), size.alias("size")]


def place(scratch: common.Scratch, rows: DataFrame, weights: dict[str, float], block: int, resolution: int) -> DataFrame:
    """Add block, slot and place to rows that have doc_id and the columns of
    ``drawn``."""
    placed = common.prefix_sums(scratch, rows, ["draw", "doc_id"], "size", "placed", group="class")
    # one row for a class: as many as there are weights
    ends = placed.groupBy("class").agg(F.max(F.col("before")).alias("last")).collect()
    plan = phases(weights, {r["class"]: r["last"] // block + 1 for r in ends}, resolution)
    schema = "class string, first_block long, end_block long, first_slot long, size long, slots array<int>"
    table = rows.sparkSession.createDataFrame(plan, schema).withColumnRenamed("class", "plan_class").withColumnRenamed("size", "period")
    number = F.floor(F.col("before") / block)
    nth = F.col("block") - F.col("first_block")
    return (placed.withColumn("block", number)
            .join(F.broadcast(table), (F.col("class") == F.col("plan_class")) & (F.col("block") >= F.col("first_block"))
                  & (F.col("block") < F.col("end_block")))
            .select(*rows.columns, "block",
                    (F.col("first_slot") + F.floor(nth / F.size("slots")) * F.col("period")
                     + F.get("slots", (nth % F.size("slots")).cast("int"))).alias("slot"),
                    (F.col("before") - F.col("block") * block).alias("place")))


def shares(weights: dict[str, float], others: float) -> dict[str, float]:
    weights = {**weights, OTHERS: others}
    if min(weights.values()) <= 0:
        raise ValueError("weights must be above 0, as every source is mixed in whole")
    return weights


def mix(docs: DataFrame, weights: dict[str, float], others: float = 1.0, block: int = BLOCK, resolution: int = RESOLUTION,
        seed: int = SEED) -> DataFrame:
    """(row, class, block, slot, place): the documents' rows, each with its
    source's class, block and slot, and its place (characters ahead of it in
    the block).  Order by slot and place to read the mixture."""
    weights = shares(weights, others)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", *drawn(weights, seed))
    return (place(common.Scratch(docs.sparkSession, "mixing"), rows, weights, block, resolution)
            .select("row", "class", "block", "slot", "place"))
