"""Token ids of whole texts by a public tokenizer file.

Where the tokenizer's pre-tokens never hold white space (those of WORD_RULES),
the ids of a text are those of its white-space separated words in turn: a task
encodes each distinct word once with the tokenizers library and remembers it.
With any other tokenizer file the library encodes each text whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hirelake.llm import words


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# FIXED VALUES: the normaliser and pre-tokenizer whose pre-tokens are parts of words.
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def parting(tokenizer) -> str:
    """The pattern of a letter, a run of ASCII marks (no apostrophe, which may
    begin an ending) and white space where the tokenizer parts letter and
    marks.  Letters that its normaliser turns into one with a combining mark at
    the end are left out, as the mark goes with the punctuation there; so are
    those from U+3000 on, whose scripts hardly part words (their words are
    encoded with the marks, which is always right)."""
    letters = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c))[0] == "L"]
    text = tokenizer.normalizer.normalize_str("".join(f"{c}, " for c in letters))
    commas = [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text) if "," in piece]
    good = [ord(c) for c, piece in zip(letters, commas, strict=True) if piece == ","]
    ranges = []
    for c in good:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    letters = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return rf"([{letters}])([!-&(-/:-@\[-`{{-~]+)(\s)"


class Encoder:
    """Encodes Arrow arrays of texts.  ``remembered``: words held at most;
    beyond, the memory starts anew (results stay the same)."""

    def __init__(self, path: str, remembered: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        vocabulary = rules["model"]["vocab"]
        added = [t for t in rules["added_tokens"]
                 if "<|" not in t["content"] or any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"]]
        self.by_words = not added and all(rules.get(k) == v for k, v in WORD_RULES.items()) and isinstance(vocabulary, dict)
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        if not self.by_words:
            return
        self.parting = parting(self.tokenizer)
        # words of a-z are their own normal form and one pre-token each
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.remembered = remembered
        self.reset()

    def reset(self):
        self.rows: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _remember(self, new: list[str], ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of the new words, whose ``ids`` stand one after another, each up to its end."""
        n = len(self.rows)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(new) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.bounds[n + 1:n + 1 + len(new)] = self.used + ends
        self.used += len(ids)
        self.rows.update(zip(new, range(n, n + len(new)), strict=True))
        return np.arange(n, n + len(new))

    def _each(self, new: list[str]):
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        ends = np.cumsum([len(x) for x in lists], dtype=np.int64)
        return np.fromiter(itertools.chain.from_iterable(lists), np.int64, ends[-1] if lists else 0), ends

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Rows of the new words.  Words of letters are encoded in one text and
        parted at the tokens that end a word, those of a-z without the
        normaliser; all others one by one."""
        rows, found = np.empty(len(new), np.int64), new.to_numpy(zero_copy_only=False)
        letters = pc.utf8_is_alpha(new).to_numpy(zero_copy_only=False)
        simple = pc.match_substring_regex(new, "^[a-z]+$").to_numpy(zero_copy_only=False)
        rows[~letters] = self._remember(rest := found[~letters].tolist(), *self._each(rest))
        for at, tokenizer in ((simple, self.plain), (letters & ~simple, self.tokenizer)):
            at = np.flatnonzero(at)
            parts = [at[k:k + 512] for k in range(0, len(at), 512)]
            texts = tokenizer.encode_batch_fast([" ".join(found[p]) for p in parts], add_special_tokens=False)
            for p, text in zip(parts, texts, strict=True):
                part, ids = found[p].tolist(), np.array(text.ids, np.int64)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != len(part) or ends[-1] != len(ids):
                    ids, ends = self._each(part)
                rows[p] = self._remember(part, ids, ends)
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, text offsets)."""
        if not self.by_words:
            ids, ends = self._each(texts.to_pylist())
            return ids.astype(np.uint32), np.concatenate([[0], ends]).astype(np.int64)
        # text that may name a special token stays as it is; in all other the
        # tokenizer would lower-case A-Z and part marks from a word anyway
        special = pc.match_substring(texts, "<|")
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), self.parting, r"\1 \2\3")
        distinct, index, offsets = words.split(pc.if_else(special, texts, plain))
        found = distinct.to_numpy(zero_copy_only=False)
        rows = np.fromiter(map(self.rows.get, found, itertools.repeat(-1)), np.int64, len(found))
        if len(self.rows) + np.count_nonzero(rows < 0) > self.remembered:
            self.reset()
            rows[:] = -1
        unknown = np.flatnonzero(rows < 0)
        if len(unknown):
            rows[unknown] = self._learn(distinct.take(pa.array(unknown)))
        if not len(index):
            return np.zeros(0, self.ids.dtype), np.zeros(len(offsets), np.int64)
        starts, sizes = self.bounds[rows], self.bounds[rows + 1] - self.bounds[rows]
        sizes = sizes[index]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts[index] - ends[:-1], sizes)
        at += np.arange(ends[-1])
        return self.ids[at], ends[offsets]


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    """The Python worker's encoder: words stay remembered from task to task."""
    return Encoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end`` after each text's ids."""
    n = len(offsets) - 1
    out = np.insert(ids, offsets[1:], np.full(n, end, ids.dtype))
    return out, offsets + np.arange(n + 1)

