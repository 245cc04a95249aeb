import functools
import os
import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelake.llm import encode, idstore, pack, queries

SMOKE = "/root/testdata/sf0.001"


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encode.default_tokenizer())


def library_ids(text, end):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(smoke_docs, awkward):
    texts = [r.text or "" for r in smoke_docs.unionByName(awkward).select("text").collect()]
    for remembered in (400_000, 50):
        encoder = encode.Encoder(encode.default_tokenizer(), remembered)
        for part in (texts[:40], texts[40:], texts):
            ids, offsets = encoder.encode(pa.array(part, pa.string()))
            for i, text in enumerate(part):
                assert ids[offsets[i]:offsets[i + 1]].tolist() == library_ids(text, 0)[:-1]


def differing(encoder, library, texts):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    return [t for i, t in enumerate(texts) if ids[offsets[i]:offsets[i + 1]].tolist() != want[i].ids]


def test_every_letter_before_every_mark(smoke_docs):
    """Letters whose normal form ends in a combining mark (Hindi, Bengali,
    Punjabi, Hebrew, Turkish) keep the punctuation behind them."""
    letters = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]
    encoder = encode.Encoder(encode.default_tokenizer(), 2_000_000)
    low = [f"a{c}{m}{w}b" for c in letters if ord(c) < 0x3000 for m in ",.;:!?" for w in " \n"]
    high = [f"a{c}{',.;:!?'[k % 6]} b" for k, c in enumerate(letters) if ord(c) >= 0x3000]
    some = ["पढ़, बड़ा. साढ़े!", "আষাঢ়, বাড়ি; হয়.", "ਸ਼, ਖ਼. ਲ਼!", "שׁ, בּ. פּ? וּ!", "İ, İİ. aİ? İstanbul, İ."]
    for texts in (some, low, high):
        assert differing(encoder, tokenizer(), texts) == []


def test_random_texts_of_marks_and_letters():
    draw = random.Random(4)
    parts = list("ab,.;:!?' \n\t\u00a0\u0130\u095c\u09df\ufb2a\u0301\u1100\u1161é😀1") + ["'s", "<|", "<|endoftext|>", "\u2028"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(20_000)]
    assert differing(encode.Encoder(encode.default_tokenizer()), tokenizer(), texts) == []


class Recorded:
    """A tokenizer that notes the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_learned_without_their_marks_and_a_to_z_without_the_normaliser():
    """op4: each word with a run of marks was learned anew, one text a word, and
    all words went through the normaliser's patterns."""
    encoder = encode.Encoder(encode.default_tokenizer())
    encoder.tokenizer = Recorded(tokenizer())
    texts = ["Alpha*** alpha, alpha.### beta&&& (\u00e9t\u00e9!!) \u00e9t\u00e9--\n", "beta alpha$$$ (alpha) it's "]
    assert differing(encoder, tokenizer(), texts) == []
    assert {"alpha", "beta", "***", ".###", "\u00e9t\u00e9"} <= set(encoder.rows)
    assert not {"alpha***", "alpha.###", "beta&&&", "\u00e9t\u00e9--", "alpha$$$"} & set(encoder.rows)
    given = " ".join(encoder.tokenizer.texts).split()
    assert len(given) == len(set(given)) and not {"alpha", "beta"} & set(given)


def test_every_ascii_mark_and_runs_of_marks():
    draw = random.Random(6)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    runs = marks + ["".join(draw.choice(marks) for _ in range(draw.randint(2, 5))) for _ in range(400)]
    letters = ["a", "Z", "\u00e9", "\u0130", "\u00df", "\u095c", "\u09df", "\ufb2a", "\u05d0", "\u1e9b", "1", "\u00b2", "e\u0301", "\u4e2d"]
    texts = [f"b{c}{run}{after}" for c in letters for run in runs for after in (" x", "\n\u0338", "\t's", "", "\x0by", "\u00a0z")]
    for remembered in (1_000_000, 50):
        encoder = encode.Encoder(encode.default_tokenizer(), remembered)
        assert [t for k in range(0, len(texts), 5000) for t in differing(encoder, tokenizer(), texts[k:k + 5000])] == []


def test_another_tokenizer_file(smoke_docs, awkward):
    """A tokenizer with other rules: each text whole, by the library."""
    from tokenizers import Tokenizer

    path = encode.default_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    encoder = encode.Encoder(path)
    assert not encoder.by_words
    texts = [r.text or "" for r in smoke_docs.unionByName(awkward).select("text").collect()]
    assert differing(encoder, Tokenizer.from_file(path), texts) == []
    row = pack.pack(awkward.where("doc_id = 50"), tokenizer=path).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == Tokenizer.from_file(path).encode(
        awkward.where("doc_id = 50").first().text, add_special_tokens=False).ids + [2]


def test_a_tokenizer_with_added_words(tmp_path):
    from tokenizers import Tokenizer

    own, path = Tokenizer.from_str(tokenizer().to_str()), str(tmp_path / "own.json")
    own.add_tokens(["onle", "***"])
    own.save(path)
    texts = ["an onle word, anonleword*** anonleword ***", "ONLE onle<|endoftext|>"]
    assert differing(encode.Encoder(path), own, texts) == []


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = pack.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(keys)].astype(int)
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def check_pieces(docs, rows):
    texts = {}
    for d in docs:
        texts.setdefault(d.doc_id, []).append(library_ids(d.text, 2))
    covered, fill = {}, {}
    for r in rows:
        assert r.length > 0 and 0 <= r.offset and r.offset + r.length <= 4096
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        assert any(len(t) == r.doc_tokens and t[r.start:r.start + r.length] == ids for t in texts[r.doc_id])
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == {k: sum(map(len, v)) for k, v in texts.items()}
    assert sorted(fill) == list(range(len(fill)))
    for i, pieces in sorted(fill.items()):
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 4096 or i == len(fill) - 1


def test_pack_awkward_rows(awkward, clashing):
    for docs in (awkward, clashing):
        check_pieces(docs.select("doc_id", "text").collect(), pack.pack(docs).collect())


def test_pack_keeps_copies_together(awkward):
    pieces = pack.pack(awkward).where("doc_id in (30, 31, 32)")
    at = sorted(4096 * r.sequence_id + r.offset for r in pieces.collect())
    total = pieces.agg(F.sum("length")).first()[0]
    assert max(4096 * r.sequence_id + r.offset + r.length for r in pieces.collect()) - at[0] == total


def test_pack_nothing(nothing):
    assert pack.pack(nothing).collect() == []


def test_sequences(awkward):
    pieces = pack.pack(awkward).cache()
    got = {r.sequence_id: r for r in pack.sequences(pieces).collect()}
    assert sum(len(r.ids) for r in got.values()) == 4 * pieces.agg(F.sum("length")).first()[0]
    first = sorted(pieces.where("sequence_id = 0").collect(), key=lambda r: r.offset)
    assert b"".join(r.ids for r in first) == bytes(got[0].ids)


def test_minimal_perfect_hash():
    for n in (0, 1, 2, 1000):
        keys = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
        levels = idstore.build_hash(keys)
        assert sorted(idstore.slots(levels, keys).tolist()) == list(range(n))
    strangers = np.random.default_rng(9).integers(0, 2**64, 1000, dtype=np.uint64)
    at = idstore.slots(levels, strangers)
    assert ((at >= -1) & (at < 1000)).all()
    with pytest.raises(ValueError):
        idstore.build_hash(np.array([5, 5], np.uint64))


def test_store_round_trip(spark, awkward, clashing, tmp_path):
    for k, docs in enumerate((awkward, clashing)):
        folder = str(tmp_path / f"s{k}")
        idstore.write(docs, folder)
        keys = [(d, o) for d, n in docs.groupBy("doc_id").count().collect() for o in range(n)]
        asked = spark.createDataFrame([*keys, (777, 0), (60, 3)], "doc_id long, occurrence long")
        got = idstore.fetch(spark, folder, asked).collect()
        assert sorted((str(r.doc_id), r.occurrence) for r in got) == sorted((str(d), o) for d, o in keys)
        texts = {}
        for d in docs.select("doc_id", "text").collect():
            texts.setdefault(d.doc_id, []).append(library_ids(d.text, 1))
        at = 0
        for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.occurrence)):
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert r.start == at and r.n_tokens == len(ids) and ids in texts[r.doc_id]
            at += r.n_tokens
        assert at == sum(len(t) for v in texts.values() for t in v)


def test_store_of_nothing(spark, nothing, tmp_path):
    idstore.write(nothing, str(tmp_path / "s"))
    asked = spark.createDataFrame([(1, 0)], "doc_id long, occurrence long")
    assert idstore.fetch(spark, str(tmp_path / "s"), asked).collect() == []
    found = idstore.locate(spark, str(tmp_path / "s"), asked).collect()
    assert [(r.doc_id, r.length) for r in found] == [(1, None)]


def test_queries(spark, smoke_docs):
    rows = smoke_docs.collect()
    store = {r.doc_id: r for r in queries.QUERIES["op4_hashed_id_store"](spark, SMOKE).collect()}
    at = 0
    for d in sorted(rows, key=lambda r: r.doc_id):
        ids = library_ids(d.text, 1)
        assert (store[d.doc_id].start, store[d.doc_id].n_tokens, store[d.doc_id].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    texts = {d.doc_id: library_ids(d.text, 2) for d in rows}
    for r in queries.QUERIES["op1_hilbert_packing"](spark, SMOKE).collect():
        assert r.ids_crc32 == crc(texts[r.doc_id][r.start:r.start + r.length])


def test_texts_are_encoded_before_they_are_sorted(spark, tmp_path):
    """op4: the sort of whole texts and the encoder's words were held by one task."""
    rows = [(2, "b b"), (1, "one, two"), (1, "other"), (None, None), (1, "other"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = idstore.encoded(docs, encode.default_tokenizer(), 1)
    assert ids.columns == ["doc_id", "text_hash", "n_tokens", "ids"]
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    folder = str(tmp_path / "store")
    idstore.write(docs, folder)
    assert sorted(os.listdir(folder)) == ["index", "payload", "shards"]
    keys = spark.createDataFrame([(k, i) for k, n in ((None, 1), (1, 3), (2, 1), (3, 1), (4, 1)) for i in range(n)], "doc_id long, occurrence long")
    found = sorted(idstore.fetch(spark, folder, keys).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.occurrence) for r in found] == [(None, 0), (1, 0), (1, 1), (1, 2), (2, 0), (3, 0)]
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    assert sorted(bytes(r.ids) for r in found) == sorted(
        np.append(encode.encoder(encode.default_tokenizer()).encode(pa.array([t or ""]))[0], 1).astype("<u4").tobytes() for _, t in rows)
