"""Links within candidate components: every pair is compared once, in blocks,
and what leaves a task is a count and one edge per member, never the pairs.

A component of many blocks repeats its members for each block that they meet, so
the pairs of blocks are gone through in rounds: what a round repeats is bounded
by the members' own bytes, and its shuffle files go when it has been written."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: A round may repeat members up to this many times their bytes in all, or this
#: many bytes if that is more.
REPEATS, LEAST_BYTES = 2, 1 << 28


def labels(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each index reaches in a boolean link matrix."""
    out = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        low = np.where(linked, out[None, :], len(out)).min(1)
        low = low[low]
        if (low == out).all():
            return out
        out = low


def _rounds(blocks: dict[int, int]) -> list[int]:
    """Ends of the rounds of offsets, for the bytes of the members by their
    groups' number of blocks.  An offset repeats a member twice (0: once)."""
    most, ends, total = max(max(blocks, default=1) // 2, 0), [], 0
    budget = max(LEAST_BYTES, REPEATS * sum(blocks.values()))
    for offset in range(most + 1):
        more = sum(x for n, x in blocks.items() if n // 2 >= offset) * (2 if offset else 1)
        if total and total + more > budget:
            ends.append(offset)
            total = 0
        total += more
    return [*ends, most + 1]


def blocked(members: DataFrame, low: int, high: int) -> DataFrame:
    """The members (own, blocks) of the pairs of blocks (first, second) whose
    offset, the way from the first around to the second, is from ``low`` to
    below ``high``; half the way around covers all pairs."""
    own, n, offset = F.col("own"), F.col("blocks"), F.col("offset")
    last = F.least(F.lit(high - 1), F.floor(n / 2).cast("int"))
    pairs = (members.where(F.floor(n / 2) >= low).withColumn("offset", F.explode(F.sequence(F.lit(low), last)))
             .withColumn("side", F.explode(F.when(offset == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
             .withColumn("first", F.when(F.col("side") == 0, own).otherwise(F.pmod(own - offset, n)))
             .withColumn("second", F.pmod(F.col("first") + offset, n)))
    return pairs.where((2 * offset != n) | (F.col("first") < F.col("second"))).drop("offset", "side", "blocks")


def compare(scratch: common.Scratch, members: DataFrame, group: str, payload: str, similar: Callable[[pa.Array], np.ndarray], block: int,
            name: str) -> DataFrame:
    """(node, links, label): for members (group, node, weight, bytes, payload),
    the weights that each member is linked to in one pair of blocks, and the
    smallest node that it reaches there.  ``similar`` gives the boolean matrix
    of a list of payloads; ``bytes`` is a payload's size."""
    sizes = scratch.write(members.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.sum("bytes").alias("bytes")),
                          f"{name}-sizes")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    # one row for a number of blocks: as many as groups of more than one block, at most
    rounds = _rounds({r["blocks"]: r["bytes"] for r in sizes.groupBy("blocks").agg(F.sum("bytes").alias("bytes")).collect()})
    dealt = members.join(sizes.select(group, "blocks"), group).select(group, "node", "weight", payload, "blocks", own)
    fields = F.struct("node", "weight", "own", F.col(payload).alias("payload"))
    if len(rounds) > 1:
        dealt = scratch.write(dealt, f"{name}-members")
    found = None
    for i, (low, high) in enumerate(zip([0, *rounds], rounds, strict=False)):
        rows = (blocked(dealt, low, high).groupBy(group, "first", "second")
                .agg(F.collect_list(fields).alias("members")).select("first", "second", "members"))
        part = rows.mapInArrow(_linked(similar), "node long, links long, label long")
        if len(rounds) > 1:
            part = scratch.write(part, f"{name}-round-{i}")
        found = part if found is None else found.unionByName(part)
    if len(rounds) > 1:
        scratch.drop(f"{name}-members")
    return found


def _linked(similar: Callable[[pa.Array], np.ndarray]) -> Callable:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("members")[i].values
                if len(held) < 2:
                    continue
                node, weight, own = (held.field(c).to_numpy() for c in ("node", "weight", "own"))
                linked = similar(held.field("payload"))
                np.fill_diagonal(linked, False)
                if batch.column("first")[i].as_py() != batch.column("second")[i].as_py():
                    linked &= own[:, None] != own[None, :]
                found = linked.any(1)
                if found.any():
                    order = np.argsort(node)
                    low = np.empty(len(node), np.int64)
                    low[order] = order[labels(linked[np.ix_(order, order)])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[found]), pa.array((linked @ weight)[found].astype(np.int64)), pa.array(node[low][found])],
                        names=["node", "links", "label"])

    return run
