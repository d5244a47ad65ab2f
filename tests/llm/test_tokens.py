"""Operators 1, 4 and 10: token files, word-table encoding, packing."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from signalloom.llm import dac, encoding, packing, word_table
from signalloom.llm.encoding import WordCache, default_vocabulary, with_end
from signalloom.sources.scratch import scratch_path
from tests.llm import brute


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab'sStTdDmlLrReEvV .,!019ÀÉßöÿ\n\t<|>-_"), max_size=6))
def test_encoder_equals_library(texts):
    flat, sizes = WordCache(default_vocabulary()).encode(texts)
    assert [p.tolist() for p in np.split(flat, np.cumsum(sizes)[:-1])] == [brute.ids_of(t) for t in texts] or not texts


def test_cache_forgets_and_stays_right():
    cache = WordCache(default_vocabulary(), max_words=3)
    for text in ("one two three four", "five six one", "", "two"):
        assert cache.encode([text])[0].tolist() == brute.ids_of(text)


@pytest.mark.parametrize("marks", ["'", "',", ",'", "''", ",''", "'',", "'%'", ".'.", "'s,'", "' '", "7'", "'7,"])
def test_marks_and_apostrophes(marks):
    texts = [f"{a}{marks}{b}" for a in ("", "o", "it's", " ") for b in ("", "s", "x", "'s", "ll'll", ",'re")]
    flat, sizes = WordCache(default_vocabulary()).encode(texts)
    assert [p.tolist() for p in np.split(flat, np.cumsum(sizes)[:-1])] == [brute.ids_of(t) for t in texts]


@pytest.fixture
def asked(monkeypatch):
    """Words that went through the library's model."""
    words, real = [], encoding.encode_words
    monkeypatch.setattr(encoding, "encode_words", lambda new, path: (words.extend(new), real(new, path))[1])
    return words


def test_model_sees_each_part_once(asked):
    text = "Word word, word. (word) word%%% word's 7word word,word"
    assert WordCache(default_vocabulary()).encode([text, text])[0].tolist() == 2 * brute.ids_of(text)
    assert sorted(asked) == sorted(["word", ",", ".", "(", ")", "%%%", "'s", "7"])


def test_cache_keeps_the_words_used_most(asked):
    cache = WordCache(default_vocabulary(), max_words=4)
    for text in ("often " * 9 + "a b c d e", "f g h i j", "often k"):
        assert cache.encode([text])[0].tolist() == brute.ids_of(text)
    assert asked.count("often") == 1 and len(cache.numbers) <= 4 + 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.sampled_from([(12, 4, 16), (8, 8, 8, 8), (3, 29), (32,)]))
def test_shard_gives_every_token(ids, widths):
    ids = np.array(ids, np.uint32)
    half = len(ids) // 2
    shard = dac.DacShard(dac.encode_shard(ids, [5, None, 7], np.array([half, 0, len(ids) - half]), widths))
    assert shard.tokens().tolist() == ids.tolist() == [shard.token(i) for i in range(len(ids))]
    assert shard.doc_ids == [5, None, 7] and shard.document(2).tolist() == ids[half:].tolist()
    with pytest.raises(IndexError):
        shard.token(len(ids))


def test_shard_refuses_ids_that_do_not_fit():
    with pytest.raises(ValueError):
        dac.encode_shard(np.array([256], np.uint32), [1], np.array([1]), (4, 4))
    with pytest.raises(ValueError):
        dac.DacShard(b"something else" * 9)


@pytest.mark.parametrize("shard_tokens", [1 << 20, 500])
def test_token_files(spark, case, shard_tokens):
    docs, pairs = case
    path = scratch_path(spark, "test-shards")
    dac.write_shards(docs, path, shard_tokens=shard_tokens)
    got = {r["doc_id"]: r for r in dac.read_documents(spark, path).collect()}
    at = 0
    for doc_id, text in sorted(pairs):
        ids = brute.ids_of(text) + [2]
        r = got.pop(doc_id)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), brute.crc(ids))
        at += len(ids)
    assert not got


def test_token_files_of_nothing(spark, empty_docs):
    path = scratch_path(spark, "test-shards")
    dac.write_shards(empty_docs, path)
    assert dac.read_documents(spark, path).count() == 0


def test_token_files_keep_repeated_and_null_ids(spark):
    rows = [(4, "same id"), (4, "same id"), (4, "other text"), (None, "no id"), (1, None)]
    path = scratch_path(spark, "test-shards")
    dac.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), path)
    got = sorted(dac.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 4, 4, 4]
    assert sum(r["n_tokens"] for r in got) == sum(len(brute.ids_of(t)) + 1 for _, t in rows)
    assert got[-1]["start"] == sum(r["n_tokens"] for r in got[:-1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=40), st.sampled_from([packing.TIERS, (64,), (8, 16)]))
def test_packing_uses_each_token_once(lengths, tiers):
    seen = [np.zeros(n, int) for n in lengths]
    sizes = []
    for sequence in packing.pack_lengths(lengths, tiers):
        sizes.append(sum(p[2] for p in sequence))
        for doc, start, length in sequence:
            assert length > 0
            seen[doc][start : start + length] += 1
    assert all((s == 1).all() for s in seen)
    assert all(n <= tiers[-1] and n & (n - 1) == 0 for n in sizes)


@pytest.mark.parametrize("block_chars", [packing.BLOCK_CHARS, 2000])
def test_packing(case, block_chars):
    docs, pairs = case
    rows = packing.pack_documents(docs, block_chars=block_chars, with_ids=True).collect()
    ids = {d: brute.ids_of(t) + [1] for d, t in pairs}
    seen = {d: np.zeros(len(i), int) for d, i in ids.items()}
    sequences, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert list(r["ids"]) == piece and r["ids_crc32"] == brute.crc(piece) and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]][r["start"] : r["start"] + r["length"]] += 1
        sequences[r["sequence_id"]].append(r)
        groups[r["step_group"]].add(r["tier"])
    assert all((s == 1).all() for s in seen.values())
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == pieces[0]["tier"] <= 2048
    assert all(len(tiers) == 1 for tiers in groups.values())


def test_packing_encodes_little_at_once(monkeypatch):
    """Whatever the size of a block: what the encoder needs for a piece of text is many times its size."""
    seen = []

    class Encoder:
        def encode(self, texts):
            seen.append(sum(map(len, texts)))
            return np.zeros(seen[-1], np.uint32), np.array(list(map(len, texts)))

    monkeypatch.setattr(packing, "word_cache", lambda vocabulary: Encoder())
    batch = pa.RecordBatch.from_pydict({"doc_id": range(400), "text": ["x" * 50_000] * 400})
    found = list(packing.encoded_blocks(iter([batch]), "any"))
    assert max(seen) <= 1 << 20 and sum(seen) == 400 * 50_000
    assert [len(names) for names, _, _ in found] == [340, 60]
    assert sum(len(flat) for _, flat, _ in found) == 400 * 50_001


def test_packing_of_nothing(empty_docs):
    assert packing.pack_documents(empty_docs).count() == 0


def test_with_end_closes_empty_texts():
    flat, sizes = with_end(np.array([7, 8], np.uint32), np.array([0, 2, 0]), 1)
    assert flat.tolist() == [1, 7, 8, 1, 1] and sizes.tolist() == [1, 3, 1]


@pytest.mark.parametrize("head_words,head_chars", [(word_table.HEAD_WORDS, word_table.HEAD_CHARS), (5, 1 << 20), (0, 0)])
def test_word_table(case, head_words, head_chars):
    docs, pairs = case
    got = {r["doc_id"]: r for r in word_table.encode_digests(docs, None, head_words, head_chars).collect()}
    assert len(got) == len(pairs)
    for doc_id, text in pairs:
        ids, r = brute.ids_of(text), got[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == brute.sha(brute.decoded(ids))


def test_word_table_of_odd_rows(spark, empty_docs):
    assert word_table.encode_documents(empty_docs).count() == 0
    rows = [(4, "same rareword"), (4, "same rareword"), (4, "other"), (None, "no id rareword"), (1, None)]
    got = word_table.encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), head_words=0).collect()
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=str) == sorted(
        ((d, brute.ids_of(t)) for d, t in rows), key=str
    )
    assert all(r["decoded"] == brute.decoded(list(r["ids"])) for r in got)


def test_word_table_of_many_copies_of_a_row(spark):
    """Copies share one set of filled places; texts for the library alone and empty ones lie between."""
    rows = [(7, "raretext of copiedwords")] * 150 + [(8, "ﬁ ligature"), (9, ""), (10, "raretext")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = word_table.encode_documents(docs, head_words=0).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == sorted((d, brute.ids_of(t)) for d, t in rows)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-1, 2**31 - 1), max_size=50))
def test_word_numbers_come_back(numbers):
    assert word_table._numbers_of(word_table._planes(np.array(numbers, np.int32))).tolist() == numbers
