"""T1 dictionary tagger, T4 category listing, S6/K8 dictionary I/O.

Tagging is one projection: lower-case, split on whitespace, strip edge
punctuation, intersect the tokens with each category's single-word keywords
and find its multi-word keywords at token boundaries of the joined tokens
(the same result as matching all 1..3-grams, without building them).  No UDF and no shuffle: a document is tagged where it is read,
however long it is, and the dictionary travels inside the plan as literals.

Token rule: leading ``,;:!?*-()"'`` and trailing ``.,;:!?*-()"'`` are
stripped, so ``.net``, ``c++``, ``c#`` and ``node.js`` stay whole while
``sql,`` and ``python.`` match.  Keywords are matched lower-cased.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import empty_to_null
from ..functions.keywords import ALL_COLUMN, LISTED_CATEGORIES, SKILL_CATEGORIES
from ..sources import sinks
from .dedup import dedup_by_key

EDGE_PUNCT = r"""^[,;:!?*\-()"']+|[.,;:!?*\-()"']+$"""
# The same rule applied to a whole text at once: a leading run after a
# space (or the start) and a trailing run before a space (or the end).  A
# trailing run is tried only from its first character, or right after a
# leading run, and taken without backtracking: a long run costs one pass.
EDGE_PUNCT_TEXT = (r"""(?<!\S)[,;:!?*\-()"']++"""
                   r"""|(?:\G|(?<![.,;:!?*\-()"']))[.,;:!?*\-()"']++(?!\S)""")


def tokens(text: str | Column) -> Column:
    """Whitespace tokens with edge punctuation stripped, empty tokens dropped.

    Built only from codegen'd functions (one regex pass over the text, a
    split and an ``array_remove``): no per-token lambda."""
    t = F.col(text) if isinstance(text, str) else text
    cleaned = F.regexp_replace(F.lower(t), EDGE_PUNCT_TEXT, "")
    return F.array_remove(F.split(cleaned, r"\s+"), "")


def _lower_list(words: Sequence[str]) -> Column:
    seen, out = set(), []
    for w in words:
        w = w.lower()
        if w not in seen:
            seen.add(w)
            out.append(w)
    return F.array(*[F.lit(w) for w in out])


def _phrase_groups(phrases: Sequence[str]) -> list[list[str]]:
    """Split multi-word keywords so that no group holds a phrase and its own
    token-prefix (only one alternative can match at a given position)."""
    def depth(p):
        return sum(1 for q in phrases if q != p and (p + " ").startswith(q + " "))
    groups: dict[int, list[str]] = {}
    for p in phrases:
        groups.setdefault(depth(p), []).append(p)
    return [groups[k] for k in sorted(groups)]


def _find_phrases(joined: Column, phrases: Sequence[str]) -> Column:
    """Every occurrence of the phrases at token boundaries of a single-space
    joined token string (zero-width lookahead matches, so overlaps count)."""
    found = []
    for group in _phrase_groups(sorted(set(phrases), key=lambda p: (-len(p), p))):
        alts = "|".join("\\Q" + p + "\\E" for p in group)
        found.append(F.regexp_extract_all(joined, F.lit(f"(?<=^| )(?=({alts})(?: |$))"), 1))
    return F.concat(*found) if len(found) > 1 else found[0]


def keyword_hits(tok: Column, keywords: Sequence[str]) -> Column:
    """The distinct keywords of the tokens in order of first occurrence, a
    keyword before a longer one that starts at the same token.

    Single-word keywords: a hash intersection with the tokens.  Multi-word
    keywords: found directly in the joined token string, so no n-gram
    arrays are built at all.  Only a text with both is put in order, by
    the place of each keyword it holds."""
    single = [w for w in keywords if " " not in w]
    phrases = sorted({w for w in keywords if " " in w})
    hits = F.array_intersect(tok, _lower_list(single)) if single else F.array().cast("array<string>")
    if not phrases:
        return hits
    joined = F.array_join(tok, " ")
    found = _find_phrases(joined, phrases)
    padded = F.concat(F.lit(" "), joined, F.lit(" "))
    placed = F.transform(F.array_distinct(F.concat(hits, found)), lambda k: F.struct(
        F.position(F.concat(F.lit(" "), k, F.lit(" ")), padded).alias("place"), F.length(k).alias("length"), k.alias("k")))
    return F.when(F.size(found) == 0, hits).otherwise(F.transform(F.array_sort(placed), lambda p: p["k"]))


def _keyword_lists(categories: Mapping[str, Sequence[str]] | None, all_column: str | None) -> dict[str, list[str]]:
    categories = SKILL_CATEGORIES if categories is None else categories
    lists = {name: [w.lower() for w in words] for name, words in categories.items()}
    if all_column:
        lists[all_column] = [w for words in lists.values() for w in words]
    return lists


def tag_keywords(df: DataFrame, text: str, *, keep: Sequence[str] = (),
                 categories: Mapping[str, Sequence[str]] | None = None,
                 all_column: str | None = ALL_COLUMN, lower_text: bool = True) -> DataFrame:
    """``keep`` columns, the (lower-cased) text and one array per category."""
    text_col = F.lower(F.col(text)) if lower_text else F.col(text)
    staged = df.select(*keep, text_col.alias(text))
    staged = staged.select(*keep, text, tokens(text).alias("_tok"))
    lists = _keyword_lists(categories, all_column)
    every = [w for words in lists.values() for w in words]
    # One pass over the text; the categories split the short hit list, which keeps its order.
    staged = staged.select(*keep, text, keyword_hits(F.col("_tok"), every).alias("_hits"))
    return staged.select(*keep, text, *[empty_to_null(F.array_intersect("_hits", _lower_list(words))).alias(n)
                                        for n, words in lists.items()])


def tag_by_table(df: DataFrame, text: str, dictionary: DataFrame, *, key: str, max_words: int = 3) -> DataFrame:
    """T1 with the dictionary as a table (category, keyword) of any size:
    (key, category, keyword, place), ``place`` being the token that the keyword
    first stands at (from 1).

    Texts are cut into tokens as in ``tag_keywords``; each token starts up to
    ``max_words`` runs of words.  Keywords of more words are left out and
    ``dictionary_lengths`` tells how many there are.  A filter of 16 bits a keyword
    (a Bloom filter, the one thing that every task holds) lets nearly no other runs
    through, each once a text with its first place, and what it lets through is
    written; the keyword itself decides, in a hash join.  Words and phrases are
    joined apart, so that Spark can broadcast the words even where the phrases are
    many.  The dictionary is written first, a row per keyword with its categories, so
    that Spark knows its size before it plans.  Only rows whose key repeats are
    grouped again; the categories multiply only what is left."""
    spark = df.sparkSession
    words = F.split("keyword", " ")
    known = (dictionary.select("category", F.lower("keyword").alias("keyword")).where((F.col("keyword") != "") & (F.size(words) <= max_words))
             .groupBy("keyword").agg(F.array_sort(F.collect_set(F.struct("category"))).alias("categories"))
             .withColumn("_words", F.size(words)))
    parts = []
    for kind, some in (("words", F.col("_words") == 1), ("phrases", F.col("_words") > 1)):
        path = sinks.scratch_path(spark, f"keyword-{kind}")
        sinks.write_table(known.where(some), path)
        parts.append((some, spark.read.schema(known.schema).parquet(path).drop("_words")))
    bits = _keyword_filter(parts[0][1].unionByName(parts[1][1]), max_words)
    runs = df.select(F.col(key).alias("_key"), tokens(text).alias("_tok"))
    schema = T.StructType([runs.schema["_key"], *T.StructType.fromDDL("keyword string, place int, _words int")])
    held = spark.sparkContext.broadcast(bits)
    path = sinks.scratch_path(spark, "keyword-runs")
    # what Python holds of the texts at a time
    with sinks.setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "8m"):
        sinks.write_table(runs.mapInArrow(_runs_let_through(held, max_words), schema), path)
    held.destroy()
    placed = spark.read.schema(schema).parquet(path)
    path = sinks.scratch_path(spark, "repeated-keys")
    sinks.write_table(df.groupBy(F.col(key).alias("_repeated")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_repeated"), path)
    repeated = spark.read.schema(T.StructType([T.StructField("_repeated", schema["_key"].dataType)])).parquet(path)
    if repeated.limit(1).count():
        same = F.col("_key").eqNullSafe(F.col("_repeated"))
        once = placed.join(repeated, same, "left_anti")
        again = placed.join(repeated, same, "left_semi").groupBy("_key", "keyword", "_words").agg(F.min("place").alias("place"))
        placed = once.unionByName(again)
    known_runs = [placed.where(some).join(part, "keyword") for some, part in parts]
    return (known_runs[0].unionByName(known_runs[1])
            .select(F.col("_key").alias(key), F.explode("categories.category").alias("category"), "keyword", "place"))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _word_codes(distinct: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in distinct.to_pylist()), np.uint64)


def _places(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each run in a filter of ``size`` bits."""
    second = (codes ^ (codes >> np.uint64(31))) * _MIX
    return codes % np.uint64(size), (second ^ (second >> np.uint64(29))) % np.uint64(size)


def _longer(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Codes of runs, each made longer by a word."""
    mixed = (codes ^ (codes >> np.uint64(29))) * _MIX + last
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word number of each token, sizes of the lists; of a null 0)."""
    coded = column.flatten().dictionary_encode()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), sizes


def _keyword_filter(known: DataFrame, max_words: int) -> np.ndarray:
    """Bloom filter of the keywords as bytes: 16 bits a keyword, two of them set."""
    piece = 1 << 15  # bits in a row of bitmap_construct_agg
    size = -(-16 * max(known.count(), 1) // piece) * piece

    def run(batches):
        for batch in batches:
            distinct, index, sizes = _lists(pc.split_pattern(batch.column("keyword"), " "))
            words, starts = _word_codes(distinct), np.cumsum(sizes) - sizes
            codes = words[index[starts]] if len(starts) else np.zeros(0, np.uint64)
            for k in range(1, max_words):
                on = sizes > k
                codes[on] = _longer(codes[on], words[index[starts[on] + k]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(codes, size)).astype(np.int64))], names=["bit"])

    rows = (known.select("keyword").mapInArrow(run, "bit long").groupBy(F.floor(F.col("bit") / piece).cast("int").alias("piece"))
            .agg(F.bitmap_construct_agg(F.col("bit") % piece).alias("bits")).collect())
    out = np.zeros((size // piece, piece // 8), np.uint8)
    for r in rows:
        out[r["piece"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def _runs_let_through(held, max_words: int, most: int = 1 << 18):
    """(_key, keyword, place, _words): of each text (_key, _tok) the runs that the
    filter lets through, each once with its first place; ``most`` tokens at a
    time, or one text."""
    def pieces(batch):
        sizes = pc.fill_null(pc.list_value_length(batch.column("_tok")), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if total + n > most and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)

    def run(batches):
        bits = held.value
        for whole in batches:
            for batch in pieces(whole):
                distinct, index, sizes = _lists(batch.column("_tok"))
                text, ends = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.cumsum(sizes), sizes)
                words = _word_codes(distinct)[index] if len(index) else np.zeros(0, np.uint64)
                at, codes = np.arange(len(index)), words
                for k in range(1, max_words + 1):
                    if k > 1:
                        on = at + k <= ends[at]
                        at = at[on]
                        codes = _longer(codes[on], words[at + k - 1])
                    first, second = _places(codes, 8 * len(bits))
                    met = np.flatnonzero((bits[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8))
                                         & (bits[second >> np.uint64(3)] >> (second & np.uint64(7)).astype(np.uint8)) & 1)
                    hit = at[met]
                    # the first of each run in its text, by the words themselves
                    columns = [text[hit], *(index[hit + i] for i in range(k))]
                    order = np.lexsort((hit, *columns))
                    new = np.ones(len(hit), bool)
                    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
                    hit = hit[order[new]]
                    if not len(hit):
                        continue
                    taken = [distinct.take(pa.array(index[hit + i])) for i in range(k)]
                    keyword = taken[0] if k == 1 else pc.binary_join_element_wise(*taken, " ")
                    place = (hit - (ends - np.repeat(sizes, sizes))[hit] + 1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column("_key").take(pa.array(text[hit])), keyword.cast(pa.string()), pa.array(place),
                                                      pa.array(np.full(len(hit), k, np.int32))], names=["_key", "keyword", "place", "_words"])

    return run


def dictionary_lengths(dictionary: DataFrame) -> DataFrame:
    """(words, keywords): how many keywords have how many words."""
    return (dictionary.select(F.lower("keyword").alias("keyword")).where(F.col("keyword") != "").distinct()
            .groupBy(F.size(F.split("keyword", " ")).alias("words")).agg(F.count(F.lit(1)).alias("keywords")))


def skills_dimension(fact: DataFrame, *, key: str = "job_id", text: str = "job_description",
                     categories: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Skill dimension: one row per key with its description lower-cased and tagged."""
    src = fact.select(key, text).where(F.col(key).isNotNull())
    one = dedup_by_key(src, [key])                                   # A11
    return tag_keywords(one, text, keep=[key], categories=categories)


# --------------------------------------------------------------- T4 / U2
def keyword_listing(skills: DataFrame, categories: Sequence[str] = tuple(LISTED_CATEGORIES)) -> DataFrame:
    """T4: distinct (element, keyword) where keyword names the category column.

    One scan and one unpivot instead of a scan per category; the distinct is
    combined map-side."""
    packed = F.array(*[F.struct(F.lit(c).alias("keyword"), F.col(c).alias("_arr")) for c in categories])
    return (skills.select(F.inline(packed))
            .select(F.explode("_arr").alias("element"), "keyword")
            .distinct())


def skill_pairs(skills: DataFrame, key: str, categories: Sequence[str]) -> DataFrame:
    """Long form of the tag arrays: (key, category, keyword)."""
    packed = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("_arr")) for c in categories])
    return (skills.select(key, F.inline(packed))
            .select(key, "category", F.explode("_arr").alias("keyword")))


# ------------------------------------------------------------- S6 / K8
def dictionary_frame(spark: SparkSession,
                     categories: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The dictionary as a (category, keyword) DataFrame (262 rows)."""
    categories = SKILL_CATEGORIES if categories is None else categories
    rows = [(c, w) for c, ws in categories.items() for w in ws]
    return spark.createDataFrame(rows, "category string, keyword string")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One keyword per line, one folder per category (as written by K8)."""
    return (spark.read.text(path).withColumnRenamed("value", "keyword")
            .where(F.col("keyword") != ""))


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """K8: each category's keywords as text, one folder per category."""
    dictionary.write.mode("overwrite").partitionBy("category").text(path)
