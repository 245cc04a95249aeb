"""Licence scans.

An Aho-Corasick automaton runs once over the words of a text and finds notice
phrases and ``SPDX-License-Identifier`` tags.  After a tag, the licence
expression (ids joined by and / or / with, brackets) is parsed by the
shunting-yard method and evaluated: each id has a restrictiveness from 0
(public domain) to 1 (all rights reserved); ``or`` takes the lower side (the
reader may choose), ``and`` the higher, ``with`` (an exception) lowers a
quarter.  A document's score is the highest over its notices and tags, 0
without any.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII.
Nulls: a null text is empty; a null doc_id passes through.  A malformed
expression counts the ids it names.  Repeated rows each get their row; other
columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: Phrases whose places are counted, with their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Further notice phrases and their licence ids.
NOTICES = {
    "mit license": "mit",
    "apache license": "apache-2.0",
    "bsd license": "bsd-3-clause",
    "mozilla public license": "mpl-2.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "creative commons attribution": "cc-by",
    "proprietary and confidential": "proprietary",
}
TAG = "spdx license identifier"

#: Restrictiveness by licence family (the id's longest listed prefix).
RESTRICTIVENESS = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "apache": 0.15, "cc-by": 0.2,
    "mpl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.6, "agpl": 0.7, "cc-by-nd": 0.8, "cc-by-nc": 0.8, "proprietary": 1.0,
    "reserved": 1.0,
}
UNKNOWN_LICENCE = 0.5
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
_TOKEN = re.compile(r"[()]|[0-9a-z][0-9a-z.+-]*")
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def restrictiveness(licence: str) -> float:
    families = [k for k in RESTRICTIVENESS if licence.startswith(k)]
    return RESTRICTIVENESS[max(families, key=len)] if families else UNKNOWN_LICENCE


def expression_tokens(text: str) -> list[str]:
    """Tokens of the expression that ``text`` (lower case) begins with: ids
    and operators in turn, up to the first that can't follow."""
    out, depth, operand = [], 0, True
    for token in _TOKEN.findall(text):
        if operand and token not in PRECEDENCE and token != ")":
            depth += token == "("
            operand = token == "("
            out.append(token if token == "(" else token.rstrip(".-"))
        elif not operand and (token in PRECEDENCE or (token == ")" and depth)):
            depth -= token == ")"
            operand = token != ")"
            out.append(token)
        else:
            break
    return out


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard; None if the brackets or operands don't match."""
    out, held, values = [], [], 0
    for token in tokens:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif token in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
        else:
            out.append(token)
            values += 1
    out += reversed(held)
    return out if "(" not in out and values == len(out) - values + 1 else None


def evaluate(tokens: list[str]) -> tuple[set[str], float]:
    """(licence ids, restrictiveness) of an expression."""
    names = {t for i, t in enumerate(tokens) if t not in PRECEDENCE and t not in "()" and (i == 0 or tokens[i - 1] != "with")}
    order = postfix(tokens)
    if order is None:
        return names, max(map(restrictiveness, names), default=0.0)
    stack = []
    for token in order:
        if token in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append(min(left, right) if token == "or" else max(left, right) if token == "and" else left * 0.75)
        else:
            stack.append(restrictiveness(token))
    return names, stack[0]


@functools.lru_cache(1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, TAG: None}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def places(words: str) -> list[tuple[str, int]]:
    """(phrase, number of its first word) for each place where a phrase stands
    in ``words``: a text's words with one blank before, between and after."""
    found, counted, number = [], 0, 0
    for end, phrase in automaton().iter(words):
        found.append((end - len(phrase) - 1, phrase))
    out = []
    for start, phrase in sorted(found):
        number += words.count(" ", counted, start)
        counted = start
        out.append((phrase, number))
    return out


def expressions(text: str, tags: list[int]) -> list[str]:
    """What follows each tag (its first word's number) in a lower-case text, up
    to the next tag or the line's end."""
    spans = [m.span() for m in _WORD.finditer(text)]
    ends = [*(spans[t][0] for t in tags[1:]), len(text)]
    width = TAG.count(" ")
    return [text[spans[t + width][1]:end].partition("\n")[0] for t, end in zip(tags, ends, strict=True)]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, and found: every place as (phrase, label, base, word,
    restrictiveness), tags among them by the ids that their expressions name."""
    kind = pa.list_(pa.struct([("phrase", pa.string()), ("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()),
                               ("restrictiveness", pa.float64())]))

    def run(batches):
        for batch in common.slices(batches, "text"):
            low = pc.ascii_lower(common.text_or_empty(batch))
            plain = pc.utf8_trim(pc.replace_substring_regex(low, _OTHER, " "), " ")
            n_words = pc.if_else(pc.equal(plain, ""), 0, pc.add(pc.count_substring(plain, " "), 1))
            found = []
            for i, words in enumerate(plain.to_pylist()):
                here = []
                for phrase, word in places(f" {words} "):
                    if phrase in BASE:
                        here.append((phrase, BASE[phrase], True, word, restrictiveness(BASE[phrase])))
                    if phrase in NOTICES:
                        here.append((phrase, NOTICES[phrase], False, word, restrictiveness(NOTICES[phrase])))
                tags = [w for p, w in places(f" {words} ") if p == TAG] if TAG in words else []
                for word, text in zip(tags, expressions(low[i].as_py(), tags) if tags else (), strict=True):
                    names, value = evaluate(expression_tokens(text))
                    here += [(TAG, name, False, word, value) for name in sorted(names)]
                found.append([dict(zip(("phrase", "label", "base", "word", "restrictiveness"), x, strict=True)) for x in here])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.cast(n_words, pa.int64()), pa.array(found, kind)],
                                             names=["doc_id", "n_words", "found"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, n_words long, found array<struct<phrase: string, label: string, "
                                "base: boolean, word: long, restrictiveness: double>>")


def summary(found: DataFrame) -> DataFrame:
    """A row per document from ``scan``."""
    base = F.filter("found", lambda x: x["base"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda x: x["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["word"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["restrictiveness"])), F.lit(0.0)).alias("score"))
