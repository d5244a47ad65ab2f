"""Operator 4: encoding by a table of distinct words, decoding by a table of pieces.

Texts are split into words in Spark tasks.  The head of the word table, the most
frequent words up to a fixed number and size, is encoded once and broadcast.
Every other occurrence goes to its word: rows (word, document, position) meet by
word, where each distinct word is encoded once, and its ids go back to the
documents, where they are put in by position.  Frequent words never travel, so
no word is hot.  A text that only the tokenizers library can split is encoded
whole, where it ends up.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import small_batches, whole_text
from signalloom.llm.encoding import default_vocabulary, encode_words, library, pieces, split_parts

#: Bounds of what is broadcast: words, and characters of all of them.
HEAD_WORDS = 400_000
HEAD_CHARS = 8 << 20
#: Distinct words counted in a task before their counts are handed on.
COUNT_WORDS = 300_000
_NO_ID = -(1 << 63)


class _Numbers(dict):
    """Word to its number in the head; -1 for any other."""

    def __missing__(self, word: str) -> int:
        return -1


class _Head:
    """The head of the word table, as it is broadcast: Arrow columns, unfolded once in each worker."""

    def __init__(self, table: pa.Table):
        self.table = table

    @functools.cached_property
    def number(self) -> Callable[[str], int]:
        """Gives a word's number, -1 for words outside the head."""
        words = self.table.column("word").to_pylist()
        return _Numbers(zip(words, range(len(words)), strict=True)).__getitem__

    @functools.cached_property
    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where those of each word start."""
        column = self.table.column("ids")
        sizes = pa.compute.list_value_length(column).to_numpy()
        starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
        return pa.compute.list_flatten(column).to_numpy().astype(np.uint32), starts


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with the key (d, tie) that finds their words again; equal rows share it."""
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    return docs.select(doc_id.alias("d"), whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))


def head_of_table(docs: DataFrame, vocabulary: str, most: int = HEAD_WORDS, chars: int = HEAD_CHARS) -> pa.Table:
    """Columns word and ids of the most frequent words, counted over all documents.

    A task leaves out words it has seen once only: they are not frequent, and
    which words are in the head changes no result.  The table ends before its
    words hold more than ``chars`` characters, so its size is bounded where it
    is made.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def sealed() -> pa.RecordBatch:
            often = {w: n for w, n in counts.items() if n > 1}
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(often.keys(), pa.string()), "n": pa.array(often.values(), pa.int64())}
            )

        for whole in batches:
            for batch in small_batches(whole, "text"):
                for text in batch.column("text").to_pylist():
                    counts.update(split_parts(text) or ())
                if len(counts) > COUNT_WORDS:
                    yield sealed()
                    counts.clear()
        yield sealed()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            ends = held + np.cumsum(pa.compute.utf8_length(batch.column("word")).to_numpy(), dtype=np.int64)
            fit = int(np.searchsorted(ends, chars, side="right"))
            words = batch.column("word").slice(0, fit)
            ids = encode_words(words.to_pylist(), vocabulary)
            yield pa.RecordBatch.from_pydict({"word": words, "ids": pa.array(ids, pa.list_(pa.int32()))})
            if fit < len(ends):
                return
            held = int(ends[-1]) if len(ends) else held

    texts = docs.select(whole_text().alias("text"))
    counts = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    short = counts.where(F.length("word") <= chars // 64)
    top = short.orderBy(F.desc("n"), "word").limit(most)
    return top.select("word").mapInArrow(encode, "word string, ids array<int>").toArrow()


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, head_words: int = HEAD_WORDS, head_chars: int = HEAD_CHARS
) -> DataFrame:
    """doc_id, ids (array), decoded text of every document.

    A null text is empty.  One row per row of ``docs``, repeated rows and null
    doc_ids included; other columns are not read.
    """
    return _encoded(docs, vocabulary, head_words, head_chars, digests=False)


def encode_digests(
    docs: DataFrame, vocabulary: str | None = None, head_words: int = HEAD_WORDS, head_chars: int = HEAD_CHARS
) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, made where they arise."""
    return _encoded(docs, vocabulary, head_words, head_chars, digests=True)


def _encoded(docs: DataFrame, vocabulary: str | None, head_words: int, head_chars: int, digests: bool) -> DataFrame:
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(_Head(head_of_table(docs, vocabulary, head_words, head_chars)))
    rows = _rows(docs)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = table.value.number
        for whole in batches:
            for batch in small_batches(whole, "text"):
                found, places, which = [], [], []
                for k, text in enumerate(batch.column("text").to_pylist()):
                    words = split_parts(text) or []
                    at = np.flatnonzero(np.fromiter(map(number, words), np.int32, len(words)) < 0)
                    found += [words[i] for i in at]
                    places.append(at)
                    which.append(np.full(len(at), k))
                take = pa.array(np.concatenate(which) if which else [], pa.int64())
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(found, pa.string()),
                        "d": batch.column("d").take(take),
                        "tie": batch.column("tie").take(take),
                        "place": pa.array(np.concatenate(places) if places else [], pa.int32()),
                    }
                )

    def once_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids = None, b""
        for batch in batches:
            words, out = batch.column("word").to_pylist(), []
            distinct = sorted(set(words) - {last})
            known = {w: np.asarray(i, "<u4").tobytes() for w, i in zip(distinct, encode_words(distinct, vocabulary), strict=True)}
            if last is not None:
                known[last] = ids
            out = [known[w] for w in words]
            if words:
                last, ids = words[-1], out[-1]
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("d", "tie", "place")} | {"ids": pa.array(out, pa.binary())}
            )

    def number_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pack = table.value.number, zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for batch in small_batches(whole, "text"):
                split, packed = [], []
                for text in batch.column("text").to_pylist():
                    words = split_parts(text)
                    split.append(words is not None)
                    if words is None:
                        packed.append(pack(text.encode()))
                    else:
                        packed.append(pack(_planes(np.fromiter(map(number, words), np.int32, len(words)))))
                yield pa.RecordBatch.from_pydict(
                    {c: batch.column(c) for c in ("d", "tie")}
                    | {"split": pa.array(split, pa.bool_()), "packed": pa.array(packed, pa.binary())}
                )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts = table.value.ids
        unpack, piece = zstandard.ZstdDecompressor().decompress, pieces(vocabulary)
        for whole in batches:
            for batch in small_batches(whole, "packed", 1 << 20):
                doc_ids = pa.array([None if d == _NO_ID else d for d in batch.column("d").to_pylist()], pa.int64())
                which, odd = [], {}
                columns = [batch.column(c).to_pylist() for c in ("split", "packed")]
                for k, (split, packed) in enumerate(zip(*columns, strict=True)):
                    which.append(_numbers_of(unpack(packed)) if split else np.empty(0, np.int32))
                    if not split:
                        found = library(vocabulary).encode(unpack(packed).decode(), add_special_tokens=False).ids
                        odd[k] = np.asarray(found, np.uint32)
                ids_of = _put_together(which, batch.column("places"), batch.column("ids"), flat, starts)
                ids_of = [odd.get(k, ids) for k, ids in enumerate(ids_of)]
                texts = [" ".join(map(piece.__getitem__, ids.tolist())) for ids in ids_of]
                if digests:
                    result = {
                        "n_tokens": pa.array(map(len, ids_of), pa.int64()),
                        "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids_of]),
                        "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                    }
                else:
                    result = {"ids": pa.array(ids_of, pa.list_(pa.int64())), "decoded": pa.array(texts, pa.string())}
                yield pa.RecordBatch.from_pydict({"doc_id": doc_ids} | result)

    occurrences = rows.mapInArrow(others, "word string, d long, tie long, place int")
    encoded = occurrences.repartition("word").sortWithinPartitions("word")
    encoded = encoded.mapInArrow(once_each, "d long, tie long, place int, ids binary")
    # A set: copies of a row bring each place once, however many they are.
    fills = encoded.groupBy("d", "tie").agg(F.collect_set(F.struct("place", "ids")).alias("fills"))
    fills = fills.select("d", "tie", F.col("fills.place").alias("places"), "fills.ids")
    packed = rows.mapInArrow(number_words, "d long, tie long, split boolean, packed binary")
    joined = packed.join(fills, ["d", "tie"], "left")
    if digests:
        schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    else:
        schema = "doc_id long, ids array<long>, decoded string"
    return joined.select("d", "split", "packed", "places", "ids").mapInArrow(finish, schema)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by bytes of equal rank, which packs better than one number after the other."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers_of(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _put_together(
    which: list[np.ndarray], places: pa.ListArray, fills: pa.ListArray, flat: np.ndarray, starts: np.ndarray
) -> list[np.ndarray]:
    """Ids of a batch of texts: head words by their number, the others as ``fills`` at ``places``."""
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, which), np.int64, len(which)))])
    number = np.concatenate(which)
    gaps = number < 0
    number = np.where(gaps, 0, number)
    first, size = (starts[number], starts[number + 1] - starts[number]) if len(starts) > 1 else np.zeros((2, len(number)), np.int64)
    texts = pa.compute.list_parent_indices(places).to_numpy()
    if len(texts):
        at = edges[texts] + pa.compute.list_flatten(places).to_numpy()
        words = pa.compute.list_flatten(fills)
        sizes = pa.compute.binary_length(words).to_numpy().astype(np.int64) // 4
        size[at] = sizes
        first[at] = len(flat) + np.cumsum(sizes) - sizes
        flat = np.concatenate([flat, np.frombuffer(b"".join(words.to_pylist()), "<u4")])
        gaps[at] = False
    if gaps.any():
        raise ValueError("a word came back without its ids")
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    found = flat[np.repeat(first - (ends - size), size) + np.arange(total)]
    return np.split(found, np.concatenate([[0], ends])[edges[1:-1]])
