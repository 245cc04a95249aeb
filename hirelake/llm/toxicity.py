"""Toxicity by a misspelling-tolerant lexicon and its context.

Learning: from a bounded sample of labelled rows, words and stems that mark
toxic texts are counted by Spark, and a small lexicon that covers the toxic
ones is chosen greedily.  The lexicon's trie, intersected with a Levenshtein
automaton (no edit for stems and words of up to 4 letters, 1 up to 8, 2
beyond), is made deterministic once; tasks then run all distinct words of a batch through its table.  Each hit
is weighed by its context window: quotation marks around it or reporting words
before it lower it, words of address raise it.  A logistic regression on a
document's hits, fitted on the same sample, gives the score.

Only text enters a score.  Nulls: a null text is empty and gets the score of a
text without hits; a null doc_id is scored but never learned from; null labels
are not learned from, and where labels of one id differ the toxic one counts.
Labels of one class only, or none, give score 0 for all.  Repeated rows each
get their score; all columns pass through inside ``row``.  An empty table stays
empty.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm import common, words

#: Marks of quotation, words of report, words of address (fixed values).
QUOTES = ['"', "“", "”", "„", "«", "»", "`"]
REPORTING = ["said", "says", "wrote", "quote", "quoted", "quotes", "word", "called", "term", "slur", "insult", "citation",
             "zitat", "sagte", "dit", "dijo", "palabra", "wort", "mot"]
ADDRESS = ["you", "your", "yours", "youre", "u", "ur", "du", "dich", "dein", "ihr", "euch", "tu", "toi", "vous", "usted", "ti"]
QUOTE_SPAN, NEAR, WINDOW = 12, 5, 20
FEATURES = ["weighed", "heaviest_window", "exact", "misspelled", "quoted", "terms", "density"]


STEMS = range(4, 8)  # lengths of stems, written with a * at their end


def tolerance(term: str) -> int:
    return 0 if len(term) <= 4 or term.endswith("*") else 1 if len(term) <= 8 else 2


class Automaton:
    """Deterministic automaton of the words within their tolerance of a
    lexicon: Levenshtein states (trie node, edits so far), taken as sets."""

    def __init__(self, lexicon: list[str]):
        children, tolerated, ends, stems = [{}], [0], {}, {}
        for number, word in enumerate(lexicon):
            node = 0
            tolerated[0] = max(tolerated[0], tolerance(word))
            for letter in word.removesuffix("*"):
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    tolerated.append(0)
                node = children[node][letter]
                tolerated[node] = max(tolerated[node], tolerance(word))
            if word.endswith("*"):
                stems[node] = -1 - number  # a state that stays whatever follows
            else:
                ends[node] = (number, tolerance(word))
        self.letters = sorted({x for w in lexicon for x in w.removesuffix("*")})
        #: Letters beyond decide nothing: only met stems live on.
        self.longest = max((len(w) + tolerance(w) for w in lexicon), default=0) + 1

        def closed(states: dict[int, int]) -> frozenset:
            states.update({stems[node]: 0 for node, edits in list(states.items()) if node in stems and not edits})
            queue = [(node, edits) for node, edits in states.items() if node >= 0]
            while queue:  # leaving out a letter of the lexicon's word
                node, edits = queue.pop()
                for child in children[node].values():
                    if edits + 1 <= tolerated[child] and edits + 1 < states.get(child, 9):
                        states[child] = edits + 1
                        queue.append((child, edits + 1))
            return frozenset(states.items())

        def step(states: frozenset, letter: str | None) -> frozenset:
            after: dict[int, int] = {}
            for node, edits in states:
                if node < 0:
                    after[node] = 0
                    continue
                moves = [(node, edits + 1)] + [(child, edits + (x != letter)) for x, child in children[node].items()]
                for child, cost in moves:
                    if cost <= tolerated[child] and cost < after.get(child, 9):
                        after[child] = cost
            return closed(after)

        start = closed({0: 0})
        numbers, todo, table = {start: 0}, [start], []
        for states in todo:
            row = []
            for letter in [None, *self.letters]:
                after = step(states, letter)
                if after not in numbers:
                    numbers[after] = len(todo)
                    todo.append(after)
                row.append(numbers[after])
            table.append(row)
        self.table = np.array(table, np.int32)
        self.term = np.full(len(todo), -1, np.int32)
        self.edits = np.full(len(todo), -1, np.int32)
        for states, n in numbers.items():
            hits = [(e, ends[node][0]) for node, e in states if node in ends and e <= ends[node][1]]
            hits += [(0, -1 - node) for node, _ in states if node < 0]
            if hits:
                self.edits[n], self.term[n] = min(hits)

    def match(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of the lexicon's word or -1, edits) for each word."""
        term, edits = np.full(len(distinct), -1, np.int32), np.zeros(len(distinct), np.int32)
        if not len(distinct) or not self.letters:
            return term, edits
        first = pc.utf8_slice_codeunits(distinct, 0, self.longest).to_pylist()
        points = np.array(first, dtype=f"<U{self.longest}").view(np.uint32).reshape(len(first), self.longest)
        known = np.array([ord(x) for x in self.letters], np.uint32)
        place = np.minimum(np.searchsorted(known, points), len(known) - 1)
        symbols = np.where(known[place] == points, place + 1, 0)
        state = np.zeros(len(first), np.int32)
        for i in range(self.longest):
            inside = points[:, i] != 0
            state = np.where(inside, self.table[state, symbols[:, i]], state)
        return self.term[state], np.maximum(self.edits[state], 0)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words and marks of lower-cased texts (as ``words.split``); * @ $ stay
    within words, where they stand for letters."""
    apart = pc.replace_substring_regex(pc.utf8_lower(texts), r"([^\pL\pM\pN\s*@$])", r" \1 ")
    return words.split(apart)


@dataclasses.dataclass
class Model:
    lexicon: list[str]
    automaton: Automaton
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray  # the last is the constant

    def probability(self, features: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(features))
        z = (features - self.means) / self.scales @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _within(sorted_positions: np.ndarray, at: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether a position stands from ``at + low`` to ``at + high``."""
    return np.searchsorted(sorted_positions, at + low) < np.searchsorted(sorted_positions, at + high, "right")


def hits(automaton: Automaton, texts: pa.Array):
    """(text, token, term, edits, quoted, weight) arrays of all hits, and the
    token count of each text."""
    distinct, index, offsets = tokens(texts)
    term, edits = automaton.match(distinct)
    listed = [np.isin(index, np.flatnonzero(pc.is_in(distinct, pa.array(x)).to_numpy(zero_copy_only=False)))
              for x in (QUOTES, REPORTING, ADDRESS)]
    quotes, reports, address = map(np.flatnonzero, listed)
    at = np.flatnonzero(term[index] >= 0)
    text = np.searchsorted(offsets, at, "right") - 1
    first, last = offsets[text] - at, offsets[text + 1] - 1 - at  # windows end with the text
    quoted = _within(quotes, at, np.maximum(-QUOTE_SPAN, first), -1) & _within(quotes, at, 1, np.minimum(QUOTE_SPAN, last))
    reported = _within(reports, at, np.maximum(-NEAR, first), -1)
    addressed = _within(address, at, np.maximum(-NEAR, first), np.minimum(NEAR, last))
    cost = edits[index[at]]
    weight = (1 - 0.2 * cost) * np.where(quoted, 0.3, 1) * np.where(reported, 0.7, 1) * np.where(addressed, 1.3, 1)
    return text, at - offsets[text], term[index[at]], cost, quoted, weight, np.diff(offsets)


def features(text, token, term, cost, quoted, weight, n_tokens) -> np.ndarray:
    n = len(n_tokens)

    def total(x):
        return np.bincount(text, x, n)

    # heaviest window: hits stand in order, so a window is a run of them
    place = text * (1 << 40) + token
    sums = np.concatenate([[0], np.cumsum(weight)])
    run = sums[np.searchsorted(place, place + WINDOW, "right")] - sums[:-1]
    heaviest = np.zeros(n)
    np.maximum.at(heaviest, text, run)
    pairs = np.unique(np.stack([text, term], 1), axis=0) if len(text) else np.zeros((0, 2), int)
    return np.stack([np.log1p(total(weight)), heaviest, np.log1p(total(cost == 0)), np.log1p(total(cost > 0)),
                     np.log1p(total(quoted)), np.bincount(pairs[:, 0].astype(int), minlength=n).astype(float),
                     np.log1p(100 * total(weight) / np.maximum(n_tokens, 1))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 2e-4, rounds: int = 50):
    """Newton's method on standardised features, both classes weighed alike
    only as they occur."""
    means, scales = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([(x - means) / scales, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge * len(x))
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return means, scales, w


def _lexicon(counted: list[tuple[str, int]], held: list[list[int]], most: int) -> list[str]:
    """Greedy cover of the toxic texts: a text counts half as much after each
    of its terms that is chosen, a clean text counts against a term, of
    equals the longer is taken, and none that begins another."""
    texts = [np.array(x, int) for x in held]
    credit = np.ones(len(texts))
    against = np.array([clean - 1e-6 * (len(term) - 2 * term.endswith("*")) for term, clean in counted], float)
    bare = np.array([term.removesuffix("*") for term, _ in counted])
    open_to = np.ones(len(counted), bool)
    sizes, flat = np.array([len(x) for x in texts], int), np.concatenate([*texts, np.zeros(0, int)])
    chosen: list[int] = []
    while len(chosen) < min(most, len(counted)):
        gain = np.bincount(flat, np.repeat(credit, sizes), len(counted)) - against
        gain[~open_to] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] < max(1.0, 0.01 * len(texts)):
            break
        chosen.append(best)
        open_to &= ~(np.char.startswith(bare, bare[best]) | np.array([bare[best].startswith(x) for x in bare]))
        credit[[best in x for x in texts]] /= 2
    return [counted[i][0] for i in chosen]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, sample_rows: int = 20_000,
        most_terms: int = 40, candidates: int = 5000) -> Model:
    """Learn from labelled rows outside the held-out fold.  ``sample_rows``
    bounds (in expectation) the labelled rows taken, chosen by a hash of the
    id; what reaches the driver are ``candidates`` term counts and a few
    numbers for each row of the sample."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~common.in_fold("doc_id", folds, held_out))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, sample_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    scratch = common.Scratch(docs.sparkSession, "toxicity")
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
              .join(known, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
              .withColumn("hash", F.xxhash64("text")).dropDuplicates(["hash"]).drop("hash"))
    sample = scratch.write(sample, "sample")
    by_class = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = by_class.get(1, 0), by_class.get(0, 0)
    empty = np.zeros(0)
    if not n_toxic or not n_clean:
        return Model([], Automaton([]), empty, empty, empty)

    def terms(batch):
        """(distinct words and stems, numbers of text and term for each term of
        a text)"""
        distinct, index, offsets = tokens(common.text_or_empty(batch))
        text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        both = np.unique(text * (len(distinct) + 1) + index)
        text, word = both // (len(distinct) + 1), both % (len(distinct) + 1)
        sizes = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
        named = [distinct, *(pc.binary_join_element_wise(pc.utf8_slice_codeunits(distinct, 0, k), "*", "") for k in STEMS)]
        coded = pa.concat_arrays(named).dictionary_encode()
        number = coded.indices.to_numpy().reshape(len(named), -1)
        texts, numbers = [text], [number[0][word]]
        for i, k in enumerate(STEMS):
            longer = sizes[word] > k
            texts.append(text[longer])
            numbers.append(number[i + 1][word[longer]])
        names = coded.dictionary
        both = np.unique(np.concatenate(texts) * (len(names) + 1) + np.concatenate(numbers))
        return names, both // (len(names) + 1), both % (len(names) + 1)

    def count(batches):
        for batch in common.slices(batches, "text"):
            names, _, number = terms(batch)
            yield pa.RecordBatch.from_arrays([names, pa.array(np.bincount(number, minlength=len(names)).astype(np.int64))],
                                             names=["term", "texts"])

    marked = (sample.where("toxic = 1").mapInArrow(count, "term string, texts long").groupBy("term").agg(F.sum("texts").alias("texts"))
              .where((F.col("texts") >= max(2, n_toxic // 100)) & F.col("term").rlike(r"^[\p{L}\p{N}]{3,24}\*?$"))
              .orderBy(F.desc("texts"), F.desc(F.length("term")), "term").limit(candidates).collect())
    number = {r["term"]: i for i, r in enumerate(marked)}

    def which(batches):
        for batch in common.slices(batches, "text"):
            names, text, term = terms(batch)
            named = np.array([number.get(w, -1) for w in names.to_pylist()], np.int64)[term]
            lists = [[] for _ in range(batch.num_rows)]
            for t, w in zip(text[named >= 0].tolist(), named[named >= 0].tolist(), strict=True):
                lists[t].append(w)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(lists, pa.list_(pa.int32()))], names=["toxic", "terms"])

    found = sample.mapInArrow(which, "toxic int, terms array<int>")
    in_clean = {r["term"]: r["n"] for r in found.where("toxic = 0").select(F.explode("terms").alias("term"))
                .groupBy("term").agg(F.count("*").alias("n")).collect()}
    rare = [i for i in range(len(marked))
            if (marked[i]["texts"] + 0.5) / (n_toxic + 1) >= 7 * (in_clean.get(i, 0) + 0.5) / (n_clean + 1)]
    place = {i: k for k, i in enumerate(rare)}
    counted = [(marked[i]["term"], in_clean.get(i, 0)) for i in rare]
    held = [[place[w] for w in r["terms"] if w in place] for r in found.where("toxic = 1").collect()]
    lexicon = _lexicon(counted, held, most_terms)
    automaton = Automaton(lexicon)

    def measure(batches):
        for batch in common.slices(batches, "text"):
            x = features(*hits(automaton, common.text_or_empty(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *map(pa.array, x.T.copy())], names=["toxic", *FEATURES])

    rows = sample.mapInArrow(measure, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES)).collect()
    x, y = np.array([r[1:] for r in rows], float), np.array([r[0] for r in rows], float)
    return Model(lexicon, automaton, *_logistic(x, y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score, hits): each document's row, its score, and the places where
    the lexicon was met (token from 0, term, edits, quoted, weight)."""
    place = pa.struct([("token", pa.int64()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()),
                       ("weight", pa.float64())])
    rows = docs.select(F.struct("*").alias("row"))

    def with_text(batches):
        for batch in batches:
            row = batch.column("row")
            yield pa.RecordBatch.from_arrays([row, pc.fill_null(row.field("text"), "")], names=["row", "text"])

    def run(batches):
        for batch in common.slices(with_text(batches), "text"):
            found = hits(model.automaton, batch.column("text"))
            text, token, term, cost, quoted, weight, n_tokens = found
            value = model.probability(features(*found))
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            each = pa.StructArray.from_arrays(
                [pa.array(token), pa.array([model.lexicon[t] for t in term.tolist()], pa.string()), pa.array(cost),
                 pa.array(quoted), pa.array(weight)], fields=list(place))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(value), pa.ListArray.from_arrays(pa.array(ends), each)], names=["row", "score", "hits"])

    added = "score double, hits array<struct<token: long, term: string, edits: int, quoted: boolean, weight: double>>"
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(added)])
    return rows.mapInArrow(run, schema)


def threshold(value: float = 0.7):
    return (F.col("score") >= value).cast("int")
