"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node.  The first neighbour lists come from a few
random-projection trees.  Then neighbours of neighbours are joined: each node
gathers its neighbours and (sampled) reverse neighbours, compares them with one
another, and proposes to each the best ones it lacks; lists keep the best
``neighbours``.  Each round is a few Spark joins, written to scratch.

A query starts from its own node's list and walks the graph greedily: of its
beam of best nodes so far, the best ones not yet opened are opened (a join of
(query, node) with the nodes' lists), until all are open.  The beam's nodes are
then scored exactly, in double precision, on the original vectors.

Graph and walk use vectors as 16-bit floats with a scale.  Nearness is the
inner product.  Vectors that are null, zero, or hold null or non-finite
components take no part, nor do those of another length than the most common
one, nor rows of null vec_id.  Repeated rows are candidates of their own, ties
go to the smaller vec_id.  Other columns are ignored.  An empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelake.llm import common, forest

TREES, LEAF, PROPOSALS = 3, 200, 8
LIST = "node long, ids array<long>, scores array<float>"


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit floats, scale) of vectors."""
    scale = np.abs(x).max(1)
    return (x / scale[:, None]).astype(np.float16), scale


def decoded(code: pa.Array, scale: np.ndarray) -> np.ndarray:
    x = np.frombuffer(b"".join(code.to_pylist()), np.float16).reshape(len(code), -1)
    return x.astype(np.float32) * scale.astype(np.float32)[:, None]


def _lists(node, ids, scores, counts):
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.ListArray.from_arrays(ends, pa.array(ids)),
         pa.ListArray.from_arrays(ends, pa.array(scores.astype(np.float32)))], names=["node", "ids", "scores"])


def _best(node, ids, scores, most):
    """Each (node, id) once with its best score, the ``most`` best of a node,
    in order."""
    order = np.lexsort((-scores, ids, node))
    node, ids, scores = node[order], ids[order], scores[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1])
    node, ids, scores = node[new], ids[new], scores[new]
    order = np.lexsort((ids, -scores, node))
    node, ids, scores = node[order], ids[order], scores[order]
    first = np.searchsorted(node, node)
    kept = np.arange(len(node)) - first < most
    return node[kept], ids[kept], scores[kept]


def merged(lists: DataFrame, most: int) -> DataFrame:
    """One list of the best for each node from any number of lists, streamed
    in order of the node, so no node's lists are ever held together."""

    def run(batches):
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        for batch in batches:
            counts = np.diff(batch.column("ids").offsets.to_numpy())
            node = np.concatenate([held[0], np.repeat(batch.column("node").to_numpy(), counts)])
            ids = np.concatenate([held[1], batch.column("ids").flatten().to_numpy()])
            scores = np.concatenate([held[2], batch.column("scores").flatten().to_numpy()])
            if not len(node):
                continue
            node, ids, scores = _best(node, ids, scores, most)
            last = node == node[-1]  # may go on in the next batch
            held = node[last], ids[last], scores[last]
            done, counts = np.unique(node[~last], return_counts=True)
            yield _lists(done, ids[~last], scores[~last], counts)
        if len(held[0]):
            yield _lists(held[0][:1], held[1], held[2], [len(held[0])])

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(run, LIST)


def _near_in(gram: np.ndarray, bound: np.ndarray, most: int):
    """(row, column) of each row's ``most`` best above its bound."""
    np.fill_diagonal(gram, -np.inf)
    most = min(most, len(gram) - 1)
    best = np.argpartition(-gram, most - 1, axis=1)[:, :most]
    good = np.take_along_axis(gram, best, 1) > bound[:, None]
    row, place = np.nonzero(good)
    return row, best[row, place]


def first_lists(scratch: common.Scratch, nodes: DataFrame, neighbours: int, sample: int) -> DataFrame:
    dealt = forest.leaves(scratch, nodes, sample, TREES, LEAF)
    sizes = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / (4 * LEAF)).alias("parts"), F.count("*").alias("size")).where("size > 1")
    groups = (dealt.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).groupBy("leaf", "part")
              .agg(F.collect_list(F.struct("node", "vector")).alias("members")).select("members"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("members")[i].values
                node = held.field("node").to_numpy()
                if len(node) < 2:
                    continue
                x = forest.vectors_of(held.field("vector")).astype(np.float32)
                gram = x @ x.T
                row, column = _near_in(gram, np.full(len(node), -np.inf), neighbours)
                yield _lists(node, node[column], gram[row, column], np.bincount(row, minlength=len(node)))

    return merged(groups.mapInArrow(run, LIST), neighbours)


def descend(graph: DataFrame, codes: DataFrame, neighbours: int) -> DataFrame:
    """Lists after one more round: the old ones and what the local joins
    propose."""
    pairs = graph.select("node", F.explode("ids").alias("id"))
    sampled = Window.partitionBy("center").orderBy(F.xxhash64("center", "member"))
    reverse = (pairs.select(F.col("id").alias("center"), F.col("node").alias("member"))
               .withColumn("place", F.row_number().over(sampled)).where(F.col("place") <= neighbours).drop("place"))
    bound = F.when(F.size("scores") >= neighbours, F.array_min("scores")).otherwise(F.lit(float("-inf")).cast("float"))
    known = codes.join(graph.select("node", bound.alias("bound")), "node", "left").withColumnRenamed("node", "member")
    members = (pairs.select(F.col("node").alias("center"), F.col("id").alias("member")).unionByName(reverse).distinct()
               .join(known, "member").groupBy("center")
               .agg(F.collect_list(F.struct("member", "code", "scale", "bound")).alias("members")).select("members"))

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for i in range(batch.num_rows):
                held = batch.column("members")[i].values
                if len(held) < 2:
                    continue
                node = held.field("member").to_numpy()
                x = decoded(held.field("code"), held.field("scale").to_numpy())
                bound = held.field("bound").to_numpy(zero_copy_only=False)
                gram = x @ x.T
                row, column = _near_in(gram, np.where(np.isnan(bound), -np.inf, bound), PROPOSALS)
                counts = np.bincount(row, minlength=len(node))
                for part, value in zip(out, (node[counts > 0], node[column], gram[row, column], counts[counts > 0]), strict=True):
                    part.append(value)
            if out[0]:
                yield _lists(*map(np.concatenate, out))

    return merged(graph.unionByName(members.mapInArrow(run, LIST)), neighbours)


def opened(graph: DataFrame, codes: DataFrame, neighbours: int) -> DataFrame:
    """(node, near): the graph to walk on, each node's list and the best
    reverse neighbours, with their vectors."""
    pairs = graph.select("node", F.explode(F.arrays_zip("ids", "scores")).alias("e")).select("node", "e.ids", "e.scores")
    best = Window.partitionBy("node").orderBy(F.desc("scores"), "ids")
    reverse = (pairs.select(F.col("ids").alias("node"), F.col("node").alias("ids"), "scores")
               .withColumn("place", F.row_number().over(best)).where(F.col("place") <= 2 * neighbours))
    both = pairs.select("node", "ids").unionByName(reverse.select("node", "ids")).distinct()
    return (both.join(codes.withColumnRenamed("node", "ids"), "ids").groupBy("node")
            .agg(F.collect_list(F.struct(F.col("ids").alias("id"), "code", "scale")).alias("near")))


STATE = "query long, vector binary, ids array<long>, scores array<float>, open array<boolean>, next array<long>"


def _settled(beam: int, at_once: int):
    """Merge what was found into each query's beam and pick what to open."""

    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i] for k in ("query", "vector", "ids", "scores", "open", "found")}
                ids, scores = (np.array(row[k].as_py() or [], kind) for k, kind in (("ids", np.int64), ("scores", np.float32)))
                done = np.array(row["open"].as_py() or [], bool)
                if row["found"].as_py():
                    lists = row["found"].values
                    new = lists.field("ids").flatten().to_numpy()
                    new, at = np.unique(new, return_index=True)
                    fresh = ~np.isin(new, ids)
                    ids = np.concatenate([ids, new[fresh]])
                    scores = np.concatenate([scores, lists.field("scores").flatten().to_numpy()[at[fresh]]])
                    done = np.concatenate([done, np.zeros(fresh.sum(), bool)])
                order = np.lexsort((ids, -scores))[:beam]
                ids, scores, done = ids[order], scores[order], done[order]
                following = np.flatnonzero(~done)[:at_once]
                done[following] = True
                out.append((row["query"].as_py(), row["vector"].as_py(), ids, scores, done, ids[following]))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.list_(pa.int64())),
                pa.array(columns[3], pa.list_(pa.float32())), pa.array(columns[4], pa.list_(pa.bool_())),
                pa.array(columns[5], pa.list_(pa.int64()))], names=["query", "vector", "ids", "scores", "open", "next"])

    return run


def _look(beam: int):
    """Score the lists of opened nodes; only what beats the beam's last goes
    back."""

    def run(batches):
        for batch in batches:
            query, ids, scores, counts = [], [], [], []
            for i in range(batch.num_rows):
                near = batch.column("near")[i].values
                x = decoded(near.field("code"), near.field("scale").to_numpy())
                value = x @ np.frombuffer(batch.column("vector")[i].as_py(), np.float32)
                good = value > batch.column("bound")[i].as_py()
                if good.any():
                    query.append(batch.column("query")[i].as_py())
                    ids.append(near.field("id").to_numpy()[good])
                    scores.append(value[good])
                    counts.append(int(good.sum()))
            if query:
                yield _lists(np.array(query), np.concatenate(ids), np.concatenate(scores), counts).rename_columns(["query", "ids", "scores"])

    return run


def walk(scratch: common.Scratch, queries: DataFrame, graph: DataFrame, near: DataFrame, beam: int, at_once: int) -> DataFrame:
    """(query, ids): the beam of each query node (query, vector) at the end."""
    start = (queries.join(graph, F.col("query") == F.col("node"), "left")
             .select("query", "vector", F.array("query").alias("ids"), F.array(F.lit(float("inf")).cast("float")).alias("scores"),
                     F.array(F.lit(True)).alias("open"),
                     F.when(F.col("ids").isNotNull(), F.array(F.struct("ids", "scores"))).alias("found")))
    state = scratch.write(start.mapInArrow(_settled(beam, at_once), STATE), "walk-0")
    ended, step = [], 0
    while True:
        ended.append(state.where(F.size("next") == 0).select("query", "ids"))
        going = state.where(F.size("next") > 0)
        if going.limit(1).count() == 0:
            break
        bound = F.when(F.size("scores") >= beam, F.array_min("scores")).otherwise(F.lit(float("-inf")).cast("float"))
        asked = going.select("query", "vector", bound.alias("bound"), F.explode("next").alias("node"))
        looked = asked.join(near, "node").select("query", "vector", "bound", "near")
        found = (looked.mapInArrow(_look(beam), "query long, ids array<long>, scores array<float>").groupBy("query")
                 .agg(F.collect_list(F.struct("ids", "scores")).alias("found")))
        step += 1
        after = going.drop("next").join(found, "query", "left").mapInArrow(_settled(beam, at_once), STATE)
        state = scratch.write(after, f"walk-{step}")
    whole = ended[0]
    for more in ended[1:]:
        whole = whole.unionByName(more)
    return whole


def nearest(vectors: DataFrame, wanted, k: int = 20, neighbours: int = 32, rounds: int = 3, beam: int = 320, at_once: int = 64,
            sample: int = 4096) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of each row
    of ``vectors`` (vec_id, embedding) for which ``wanted`` (a condition on
    vec_id) holds."""
    scratch = common.Scratch(vectors.sparkSession, "nndescent")
    rows = scratch.write(vectors.where(forest.sound("embedding") & F.col("vec_id").isNotNull())
                         .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"),
                                 F.monotonically_increasing_id().alias("row")), "rows")
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    length = lengths[0]["length"] if lengths else 0
    # of equal vectors, only the k + 1 with the smallest ids can be among a query's nearest
    ordered = Window.partitionBy("vector").orderBy("vec_id", "row")
    usual = rows.where(F.size("vector") == length)
    nodes = scratch.write(usual.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= k + 1).groupBy("vector")
                          .agg(F.min("row").alias("node"), F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("copies")), "nodes")

    def code(batches):
        for batch in batches:
            if batch.num_rows:
                x, scale = coded(forest.vectors_of(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(scale)],
                                                 names=["node", "code", "scale"])

    codes = scratch.write(nodes.select("node", "vector").mapInArrow(code, "node long, code binary, scale double"), "codes")
    graph = scratch.write(first_lists(scratch, nodes.select("node", "vector"), neighbours, sample), "graph-0")
    for i in range(1, rounds + 1):
        graph = scratch.write(descend(graph, codes, neighbours), f"graph-{i}")
        scratch.drop(f"graph-{i - 1}")
    near = scratch.write(opened(graph, codes, neighbours), "near")

    asking = scratch.write(usual.where(wanted).select("vec_id", "row", "vector")
                           .join(nodes.select("vector", "node"), "vector").select("vec_id", "row", "node"), "asking")

    def single(batches):
        for batch in batches:
            x = decoded(batch.column("code"), batch.column("scale").to_numpy()) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["query", "vector"])

    starts = codes.join(asking.select("node").distinct(), "node").mapInArrow(single, "query long, vector binary")
    beams = scratch.write(walk(scratch, starts, graph, near, beam, at_once), "beams")

    def exact(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("members")[i].values
                query = np.array(batch.column("vector")[i].as_py(), np.float64)
                node, value = held.field("node").to_numpy(), (forest.vectors_of(held.field("vector")) * query).sum(1)
                # equal scores may all hold smaller ids: keep every node that ties with the last
                last = np.sort(value)[::-1][min(k, len(value) - 1)]
                good = value >= last
                yield pa.RecordBatch.from_arrays([pa.array(np.full(good.sum(), batch.column("query")[i].as_py())), pa.array(node[good]),
                                                  pa.array(value[good])], names=["query", "near_node", "score"])

    scored = (beams.select("query", F.explode("ids").alias("node")).join(nodes.select("node", "vector"), "node").groupBy("query")
              .agg(F.collect_list(F.struct("node", "vector")).alias("members"))
              .join(nodes.select(F.col("node").alias("query"), "vector"), "query")
              .mapInArrow(exact, "query long, near_node long, score double"))
    found = (asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), F.col("node").alias("query"))
             .join(scored, "query").join(nodes.select(F.col("node").alias("near_node"), F.explode("copies").alias("copy")), "near_node")
             .where("copy.row != query_row").select("query_id", "query_row", F.col("copy.vec_id").alias("vec_id"), "copy.row", "score"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
