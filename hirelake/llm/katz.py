"""Scoring texts by a Katz backoff model of word pairs.

Counts of words and word pairs are discounted by Good-Turing (counts up to 5;
larger ones by the absolute discount of 5, so every context keeps backoff
mass); a pair never seen backs off to the word, weighed so that each context's
probabilities add up to one exactly; an unseen word takes the mass that
Good-Turing leaves, as one class.  P(w | v) is evaluated from the pair, to the
word, to the unseen class.

Documents are gathered to blocks of bounded text (a longer text is a block of
its own).  A block counts its distinct words and pairs; the counts meet in
tables partitioned by hash of the word or pair, which send the totals back to
the blocks that asked, in the order of their keys; a block then scores its
documents with them.  So what is shuffled is what is distinct in a block and
not every token.  Each distinct pair is charged to its context by one block (its owner); summed by context in
another partitioned table, that gives the exact backoff weights.

Words are runs of anything but space and tab to carriage return, A-Z
lower-cased; each text is followed by one end, and preceded by a start that is
context only.  Words are known by 64-bit hashes.  Nulls: a null text is empty
(its end alone); a null doc_id is learned from and scored.  Repeated rows each
count and get their score.  Other columns are ignored.  An empty table gives no
rows; without training texts every word is unseen, at log10 probability 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common, words

K, BLOCK_BYTES = 5, 10 << 20
END, START = words.code(" end"), words.code(" start")  # no word holds a blank


def discounts(counted: list[int]) -> np.ndarray:
    """Discounted counts r* for r = 0 .. K + 1 from the numbers of types that
    occur 1 .. K + 1 times; from r = K + 1 on, r* is r less the same amount.
    Where Good-Turing's formula gives no discount, half a count is taken."""
    n = [0.0, *map(float, counted)]
    out = np.arange(K + 2, dtype=float)
    for r in range(1, K + 1):
        turing = (r + 1) * n[r + 1] / n[r] if n[r] else 0.0
        cut = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        star = (turing - r * cut) / (1 - cut) if 0 <= cut < 1 else 0.0
        out[r] = star if 0 < star < r else r - 0.5
    out[K + 1] = K + 1 - (K - out[K])
    return out


def starred(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    counts = np.asarray(counts, np.float64)
    return np.where(counts > K, counts - (K + 1 - table[K + 1]), table[np.minimum(counts, K).astype(int)])


def pair_codes(before: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return words.spread(before * words.MIX + codes)


def _gathered(batches):
    """Rows of about BLOCK_BYTES of text: block, and the documents in it."""
    names = ["block", "doc_id", "text", "held_out"]
    block, held, size = TaskContext.get().partitionId() << 20, [], 0

    def row():
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        ends = pa.array([0, table.num_rows], pa.int32())
        lists = (pa.ListArray.from_arrays(ends, table.column(c)) for c in names[1:])
        return pa.RecordBatch.from_arrays([pa.array([block]), *lists], names=names)

    for batch in common.slices(batches, "text", BLOCK_BYTES // 8):
        more = batch.column("text").nbytes
        if held and size + more > BLOCK_BYTES:
            yield row()
            block, held, size = block + 1, [], 0
        held.append(batch)
        size += more
    if held:
        yield row()


def _whole(texts: pa.Array):
    """(distinct codes, word number of each token, number of the token before,
    text number) of a block; the last code is the end, and the number after it
    stands for the start."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    codes, index, sizes, seen = [], [], [], 0
    for part in common.slices(iter([batch]), "text"):
        distinct, numbers, offsets = words.split(words.lower(part.column("text")))
        codes.append(words.codes(distinct))
        index.append(np.insert(numbers.astype(np.int64) + seen, offsets[1:], -1))
        sizes.append(np.diff(offsets) + 1)
        seen += len(distinct)
    empty = np.zeros(0, np.int64)
    index, sizes = np.concatenate([*index, empty]), np.concatenate([*sizes, empty])
    distinct, number = np.unique(np.concatenate([*codes, np.zeros(0, np.uint64)]), return_inverse=True)
    word = np.append(number, len(distinct))[index]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[(np.cumsum(sizes) - sizes)] = len(distinct) + 1
    return np.append(distinct, np.uint64(END)), word, before, np.repeat(np.arange(len(sizes)), sizes)


def _asked(kind: int, values: np.ndarray, learned: np.ndarray, block: int, parts: int) -> list[pa.RecordBatch]:
    """A block's distinct values by part of the key space, in order, and how
    often each was learned from; those learned once, the most, go without a
    number."""
    key, at = np.unique(values, return_inverse=True)
    n = np.bincount(at, learned, len(key)).astype(np.int64)
    bounds = np.array([i * 2**64 // parts for i in range(parts)], np.uint64)
    out = []
    for chosen, counts in ((n == 1, None), (n != 1, n[n != 1])):
        some = key[chosen]
        ends = np.append(np.searchsorted(some, bounds), len(some))
        part = np.flatnonzero(np.diff(ends))
        lists = pa.array(np.append(ends[part], len(some)).astype(np.int32))
        numbers = pa.nulls(len(part), pa.list_(pa.int64())) if counts is None else pa.ListArray.from_arrays(lists, pa.array(counts))
        out.append(pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(np.full(len(part), block)), pa.array(np.full(len(part), kind, np.int8)),
             pa.ListArray.from_arrays(lists, pa.array(some.view(np.int64))), numbers], names=["part", "block", "kind", "keys", "counts"]))
    return out


def _answered(asked: pa.Table) -> pa.Table:
    """Totals of one part of the key space: for each block that asked, in the
    order of its keys, twice the total, and 1 more for the key's owner, the
    first block that learned it.  Rows of block -1 count types and tokens."""
    part, out = asked.column("part")[0].as_py(), []
    for kind in (1, 2):
        rows = asked.filter(pc.equal(asked.column("kind"), kind)).combine_chunks()
        if not rows.num_rows:
            continue
        key = pc.list_flatten(rows.column("keys")).to_numpy().view(np.uint64)
        sizes = pc.list_value_length(rows.column("keys")).to_numpy()
        block = np.repeat(rows.column("block").to_numpy(), sizes)
        n = np.ones(len(key), np.int64)
        n[np.repeat(rows.column("counts").is_valid().to_numpy(), sizes)] = pc.list_flatten(rows.column("counts")).to_numpy()
        order = np.lexsort((block, key))
        key, block, n = key[order], block[order], n[order]
        new = np.append(True, key[1:] != key[:-1])
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        total = np.add.reduceat(n, first)
        places = np.where(n > 0, np.arange(len(n)), len(n))
        mine = (places == np.minimum.reduceat(places, first)[group]) & (n > 0)
        value = 2 * total[group] + mine
        back = np.lexsort((key, block))
        names, ends = np.unique(block[back], return_index=True)
        out.append(_answer(names, kind, part, np.append(ends, len(back)), value[back]))
        known = total[total > 0]
        counted = [*np.bincount(known[known <= K + 1], minlength=K + 2)[1:], len(known), known.sum()]
        out.append(_answer([-1], kind, part, [0, len(counted)], np.array(counted)))
    return pa.Table.from_batches(out)


def _answer(block, kind, part, ends, values) -> pa.RecordBatch:
    n = len(ends) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array([kind] * n, pa.int8()), pa.array([part] * n, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))], names=["block", "kind", "part", "totals"])


def score(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of each document; ``held_out`` is a condition on documents that are scored
    but not learned from."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "katz")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = scratch.write(rows.mapInArrow(
        _gathered, "block long, doc_id array<long>, text array<string>, held_out array<boolean>"), "blocks")

    # 1. what each block asks for: its distinct words (kind 1) and pairs (2)
    parts = max(common.partitions(spark), 1)

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("held_out")[i].values.to_numpy(zero_copy_only=False)
                distinct, word, before, text = _whole(batch.column("text")[i].values)
                learned, block = ~held[text], batch.column("block")[i].as_py()
                yield from _asked(1, distinct[word], learned, block, parts)
                pairs = pair_codes(np.append(distinct, np.uint64(START))[before], distinct[word])
                yield from _asked(2, pairs, learned, block, parts)

    # 2. totals over all blocks; what each part of the key space holds is one partition's share
    asked = blocks.mapInArrow(ask, "part long, block long, kind byte, keys array<long>, counts array<long>")
    answers = scratch.write(asked.groupBy("part").applyInArrow(_answered, "block long, kind byte, part long, totals array<long>"),
                            "answers")
    counted = (answers.where("block = -1").select("kind", F.posexplode("totals")).groupBy("kind", "pos").agg(F.sum("col").alias("n"))
               .collect())  # a few numbers
    counted = {(r["kind"], r["pos"]): r["n"] for r in counted}
    stats = {f"n{k}_{r}": counted.get((k, r - 1), 0) for k in (1, 2) for r in range(1, K + 2)}
    n_types, n_tokens = counted.get((1, K + 1), 0), counted.get((1, K + 2), 0)
    word_table = discounts([stats[f"n1_{r}"] for r in range(1, K + 2)])
    pair_table = discounts([stats[f"n2_{r}"] for r in range(1, K + 2)])

    # 3. answers go back to the blocks that asked, which score their documents
    mass = float(starred(np.arange(1, K + 1), word_table) @ [stats[f"n1_{r}"] for r in range(1, K + 1)])
    n_large = n_types - sum(stats[f"n1_{r}"] for r in range(1, K + 1))
    large_tokens = n_tokens - sum(r * stats[f"n1_{r}"] for r in range(1, K + 1))
    mass += large_tokens - n_large * (K + 1 - word_table[K + 1])
    unseen = 1 - mass / n_tokens if n_tokens else 1.0
    starts = rows.where("not held_out").count()

    def lookup(answered: pa.Table, kind: int, values: np.ndarray):
        """(count, whether it is the block's own) of each value."""
        rows = answered.filter(pc.equal(answered.column("kind"), kind)).sort_by("part")
        total = pc.list_flatten(rows.column("totals")).to_numpy()
        total = total[np.unique(values, return_inverse=True)[1]]
        return total >> 1, (total & 1) > 0

    def judge(documents: pa.Table, answered: pa.Table):
        if not documents.num_rows:
            return _row("document", 0, table=True)
        block = documents.column("block")[0].as_py()
        doc_id, texts, held = (documents.column(c)[0].values for c in ("doc_id", "text", "held_out"))
        held = held.to_numpy(zero_copy_only=False)
        distinct, at, of_frame, text = _whole(texts)
        n = len(held)
        count = lookup(answered, 1, distinct)[0]
        p_word = np.where(count > 0, starred(count, word_table) / max(n_tokens, 1), unseen)
        frame, total_frame = np.append(distinct, np.uint64(START)), np.append(count, starts)
        total_frame[-2] = 0  # nothing follows an end
        # pairs as the block numbers them, then their codes
        _, first, of_pair = np.unique(of_frame * len(frame) + at, return_index=True, return_inverse=True)
        frame_of_pair, word_of_pair = of_frame[first], at[first]
        pair = pair_codes(frame[frame_of_pair], distinct[word_of_pair])
        total, mine = lookup(answered, 2, pair)
        known = total[of_pair] > 0
        with np.errstate(divide="ignore"):
            direct = np.log10(starred(total, pair_table) / np.maximum(total_frame[frame_of_pair], 1))
        logs = np.where(known, direct[of_pair], np.log10(p_word[at]))
        base = np.log10((count + 1) / (n_tokens + n_types + 1))
        per_text = [np.bincount(text, minlength=n), np.bincount(text, count[at] > 0, n).astype(np.int64),
                    np.bincount(text, base[at], n), np.bincount(text, logs, n)]
        # contexts: what their learned pairs take, of the pairs and of the words; and who waits for their weight
        taken = np.bincount(frame_of_pair[mine], starred(total[mine], pair_table), len(frame))
        shadowed = np.bincount(frame_of_pair[mine], p_word[word_of_pair[mine]], len(frame))
        named = np.flatnonzero(np.bincount(frame_of_pair[mine], minlength=len(frame)))
        waits = np.flatnonzero(~known & (total_frame[of_frame] > 0))
        wait, times = np.unique(np.stack([text[waits], of_frame[waits]], 1), axis=0, return_counts=True)
        row = np.arange(n, dtype=np.int64) + (np.int64(block) << 24)
        return pa.Table.from_batches([b for b in (
            _row("document", n, row=row, doc_id=doc_id, held_out=pa.array(held), n_tokens=per_text[0], n_known=per_text[1],
                 base=per_text[2], value=per_text[3]),
            _row("context", len(named), key=frame[named].view(np.int64), n_tokens=total_frame[named].astype(np.int64), base=shadowed[named],
                 value=taken[named]),
            _row("wait", len(wait), row=row[wait[:, 0]] if len(wait) else row[:0],
                 key=frame[wait[:, 1]].view(np.int64) if len(wait) else row[:0], n_tokens=times.astype(np.int64)),
        )])

    columns = ("what string, row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, value double, "
               "key long")
    judged = scratch.write(blocks.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInArrow(judge, columns), "judged")
    scratch.drop("answers", "blocks")

    # 4. backoff weights: what a context leaves, over what its unseen words would take
    weights = (judged.where("what = 'context'").groupBy("key")
               .agg(F.max("n_tokens").alias("total"), F.sum("value").alias("taken"), F.sum("base").alias("shadowed"))
               .select("key", F.log10((1 - F.col("taken") / F.col("total")) / (1 - F.col("shadowed"))).alias("weight")))
    late = (judged.where("what = 'wait'").select("row", "key", F.col("n_tokens").alias("times")).join(weights, "key")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("weight")).alias("late")))
    return (judged.where("what = 'document'").join(late, "row", "left")
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"),
                    F.col("base").alias("base_score"), (F.col("value") + F.coalesce("late", F.lit(0.0))).alias("score")))


def _row(what: str, n: int, table: bool = False, **columns):
    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
             "base": pa.float64(), "value": pa.float64(), "key": pa.int64()}
    batch = pa.RecordBatch.from_arrays(
        [pa.array([what] * n, pa.string()),
         *(pc.cast(pa.array(columns[k]) if not isinstance(columns[k], pa.Array) else columns[k], t) if k in columns else pa.nulls(n, t)
           for k, t in kinds.items())], names=["what", *kinds])
    return pa.Table.from_batches([batch]) if table else batch
