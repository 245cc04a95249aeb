"""Embedding near-dedup by a forest of random-projection trees.

Equal vectors are one class.  Each tree splits the classes by random directions
near the median of what a node holds, and vectors close to a split go down both
sides (spill overlap), until nodes are small.  Trees are laid out several
levels at a time: a bounded sample of a node (``sample`` vectors, chosen by
hash) gives the cut points of the levels below it, the directions come from a
seed, and every vector of the node is then dealt.  Nodes still too large after
a few rounds (dense groups) are kept whole and compared in blocks.

Within leaves all pairs are compared by cosine in double precision; links join
vectors into components, and within a component every pair is compared once, in
blocks, for the numbers of links.

Vectors that are null, zero, or hold null or non-finite components link with
nothing.  Vectors of another length than the most common one are compared among
their own length in blocks.  A null vec_id takes part, but names no component
unless all of it are null.  Repeated rows are vectors of their own, linked with
each other.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common, links

TREES, LEAF, ROUNDS, LEVELS, SPILL, SEED = 10, 256, 4, 8, 0.04, 3


def sound(column: str):
    """Whether a vector can be compared: a length, and no null, NaN or infinite
    component, and not all 0."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def vectors_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def direction(leaf: int, node: int, dimension: int) -> np.ndarray:
    return np.random.default_rng([SEED, leaf & (2**63 - 1), node]).standard_normal(dimension)


def lay_out(leaf: int, sample: np.ndarray, size: int, leaf_size: int = LEAF) -> list[float]:
    """Cut points (low, high) of the nodes below ``leaf`` in a complete binary
    tree, level by level: what lies above low goes right, what lies below high
    goes left."""
    levels = min(LEVELS, max(1, int(np.ceil(np.log2(max(size, 2) / leaf_size)))))
    cuts, held = [], {1: np.arange(len(sample))}
    draw = np.random.default_rng([SEED, leaf & (2**63 - 1)])
    for node in range(1, 1 << levels):
        at = held.get(node, np.zeros(0, int))
        middle = draw.uniform(0.4, 0.6)
        if len(at) < 4:
            cuts += [np.inf, np.inf]  # too few to tell: all go left
            held[2 * node], held[2 * node + 1] = at, at[:0]
            continue
        along = sample[at] @ direction(leaf, node, sample.shape[1])
        low, high = np.quantile(along, [middle - SPILL, middle + SPILL])
        cuts += [low, high]
        held[2 * node], held[2 * node + 1] = at[along <= high], at[along > low]
    return cuts


def deal(leaf: int, cuts: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``x``, node) for each bottom node that a vector reaches."""
    nodes = len(cuts) // 2
    rows, at = np.arange(len(x)), np.ones(len(x), np.int64)
    while len(at) and at[0] <= nodes:
        low, high, along = np.empty(len(at)), np.empty(len(at)), np.empty(len(at))
        for node in np.unique(at).tolist():
            here = at == node
            along[here] = x[rows[here]] @ direction(leaf, node, x.shape[1])
            low[here], high[here] = cuts[2 * node - 2], cuts[2 * node - 1]
        left, right = along <= high, along > low
        rows, at = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * at[left], 2 * at[right] + 1])
    return rows, at


def _dealt(batch_leaf: int, cuts, node_ids: np.ndarray, x: np.ndarray):
    rows, at = deal(batch_leaf, np.asarray(cuts), x)
    # the next leaf's name: the old one's and the node's, mixed
    child = (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(batch_leaf & (2**64 - 1))
    child = (child ^ (child >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return node_ids[rows], (child ^ (child >> np.uint64(29))).view(np.int64), rows


def _batch(node, leaf, column, rows):
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(leaf), column.take(pa.array(rows))], names=["node", "leaf", "vector"])


def leaves(scratch: common.Scratch, nodes: DataFrame, sample: int, trees: int = TREES, leaf_size: int = LEAF) -> DataFrame:
    """(node, leaf, vector) over all trees, for nodes (node, vector)."""
    schema = f"node long, leaf long, vector {nodes.schema['vector'].dataType.simpleString()}"
    total = nodes.count()
    share = min(1.0, sample / max(total, 1))
    chosen = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vector").collect()
    held = unit(np.array([r[0] for r in chosen], np.float64)) if chosen else np.zeros((0, 1))
    plans = [lay_out(t, held, total, leaf_size) for t in range(trees)] if total > leaf_size and len(held) else None

    def first(batches):
        for batch in batches:
            node, column = batch.column("node").to_numpy(), batch.column("vector")
            if not len(node):
                continue
            x = unit(vectors_of(column))
            if plans is None:
                yield _batch(node, np.zeros(len(node), np.int64), column, np.arange(len(node)))
                continue
            for tree, cuts in enumerate(plans):
                found, child, at = _dealt(tree, cuts, node, x)
                yield _batch(found, child, column, at)

    dealt = scratch.write(nodes.select("node", "vector").mapInArrow(first, schema), "leaves-0")
    out = []
    for round_ in range(1, ROUNDS + 1):
        sizes = dealt.groupBy("leaf").agg(F.count("*").alias("size"))
        large = sizes.where(F.col("size") > 4 * leaf_size)
        if round_ == ROUNDS or large.limit(1).count() == 0:
            out.append(dealt)
            break
        marked = dealt.join(large, "leaf", "left")
        out.append(marked.where("size is null").drop("size"))
        rest = marked.where("size is not null")
        picked = F.pmod(F.xxhash64("node", "leaf"), F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(512.0) / F.col("size")) * (1 << 30)

        def plan(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    leaf, size = batch.column("leaf")[i].as_py(), batch.column("size")[i].as_py()
                    x = unit(vectors_of(batch.column("vectors")[i].values))
                    yield pa.RecordBatch.from_arrays([pa.array([leaf]), pa.array([lay_out(leaf, x, size, leaf_size)])], names=["leaf", "cuts"])

        # about 512 vectors of a leaf
        plans_of = (rest.where(picked).groupBy("leaf", "size").agg(F.collect_list("vector").alias("vectors"))
                    .mapInArrow(plan, "leaf long, cuts array<double>"))

        def again(batches):
            for batch in batches:
                leaf, node, column = batch.column("leaf").to_numpy(), batch.column("node").to_numpy(), batch.column("vector")
                if not len(leaf):
                    continue
                x = unit(vectors_of(column))
                for one in np.unique(leaf).tolist():
                    here = np.flatnonzero(leaf == one)
                    cuts = batch.column("cuts")[int(here[0])].as_py()
                    if cuts is None:
                        yield _batch(node[here], leaf[here], column, here)
                    else:
                        found, child, rows = _dealt(one, cuts, node[here], x[here])
                        yield _batch(found, child, column, here[rows])

        dealt = scratch.write(rest.join(plans_of, "leaf", "left").select("leaf", "node", "vector", "cuts").mapInArrow(again, schema),
                              f"leaves-{round_}")
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _similar(threshold: float):
    def run(column: pa.Array) -> np.ndarray:
        x = vectors_of(column)
        dot, length = x @ x.T, np.sqrt((x * x).sum(1))
        with np.errstate(all="ignore"):
            cosine = dot / (length[:, None] * length[None, :])
            if not np.isfinite(cosine).all():  # components too large or small to square
                y = unit(x)
                cosine = y @ y.T
        return cosine >= threshold

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, sample: int = 4096, block: int = 512) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors``
    (vec_id, embedding).  ``sample``: vectors (in expectation) that lay out the
    trees' first levels; all vectors are dealt."""
    scratch = common.Scratch(vectors.sparkSession, "forest")
    rows = scratch.write(vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                        F.col("embedding").alias("vector"), sound("embedding").alias("sound")), "rows")
    classes = scratch.write(rows.where("sound").groupBy("vector").agg(
        F.min("row").alias("node"), F.count("*").alias("weight"), F.min("vec_id").alias("low")), "classes")
    lengths = classes.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    length = lengths[0]["length"] if lengths else 0
    usual = classes.where(F.size("vector") == length)
    dealt = leaves(scratch, usual.select("node", "vector"), sample)
    odd = classes.where(F.size("vector") != length).select("node", (-1 - F.size("vector")).cast("long").alias("leaf"), "vector")
    members = dealt.unionByName(odd).withColumn("weight", F.lit(1).cast("long"))
    crowded = members.groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1")
    size = (8 * F.size("vector")).cast("long").alias("bytes")
    met = links.compare(scratch, members.join(crowded.select("leaf"), "leaf").select("*", size), "leaf", "vector", _similar(threshold), 4 * LEAF, "met")
    edges = met.where("label != node").select(F.col("node").alias("a"), F.col("label").alias("b"))
    groups = scratch.write(common.components(scratch, edges, "components"), "groups")
    held = groups.join(classes, "node")
    linked = (links.compare(scratch, held.select("component", "node", "weight", "vector", size), "component", "vector", _similar(threshold), block, "held")
              .groupBy("node").agg(F.sum("links").alias("links")))
    joined = (classes.select("node", "weight", "low").join(groups, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    lows = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    by_node = (joined.join(lows, "component").join(linked, "node", "left")
               .select("node", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = classes.select("vector", F.col("node").alias("of")).join(by_node, F.col("of") == F.col("node")).drop("of", "node")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (rows.join(named.withColumn("sound", F.lit(True)), ["vector", "sound"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")))
