"""Operator 7: exact duplicates by owners of byte strings in radix tries.

Texts are normalised (A-Z lowered, nothing else) and inserted whole into a
compressed radix trie; the node where a text ends holds the identifier that
stays and the number of copies.  A first trie per task collapses copies before
anything is shuffled, so a text that fills a third of the table crosses the
network once per task.  The owners of a (length, hash) partition insert what is
left.  A trie over its byte budget spills its largest subtree: the texts below
are emitted with what is known of them, and partial rows are summed at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import release_memory, small_batches, whole_text

TRIE_BYTES = 24 << 20

_NODE_BYTES = 300  # of a node besides its label, about


class _Node:
    __slots__ = ("children", "label", "owner")

    def __init__(self, label: bytes, owner: tuple[int | None, int] | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, _Node] = {}


def _prefix(a: bytes, b: bytes) -> int:
    """How many bytes ``a`` and ``b`` share at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


class RadixTrie:
    """Byte strings with the identifier that stays and the number of copies."""

    def __init__(self, keep_largest: bool):
        self.root = _Node(b"")
        self.bytes = 0
        self.keep_largest = keep_largest

    def merged(self, old: tuple[int | None, int] | None, new: tuple[int | None, int]) -> tuple[int | None, int]:
        """A missing identifier gives way to any other."""
        if old is None:
            return new
        known = [i for i in (old[0], new[0]) if i is not None]
        keep = (max(known) if self.keep_largest else min(known)) if known else None
        return keep, old[1] + new[1]

    def insert(self, text: bytes, owner: tuple[int | None, int]) -> None:
        node, rest = self.root, text
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = _Node(rest, owner)
                self.bytes += len(rest) + _NODE_BYTES
                return
            shared = _prefix(child.label, rest)
            if shared < len(child.label):
                upper = _Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
                self.bytes += _NODE_BYTES
            node, rest = child, rest[shared:]
        node.owner = self.merged(node.owner, owner)

    def _size(self, node: _Node) -> int:
        todo, size = [node], 0
        while todo:
            n = todo.pop()
            size += len(n.label) + _NODE_BYTES
            todo += n.children.values()
        return size

    def spill(self) -> Iterator[tuple[bytes, tuple[int | None, int]]]:
        """Remove the largest subtree below the root and yield its texts."""
        if self.root.owner is not None:
            yield b"", self.root.owner
            self.root.owner = None
        if not self.root.children:
            return
        sizes = {first: self._size(node) for first, node in self.root.children.items()}
        first = max(sizes, key=sizes.__getitem__)
        self.bytes -= sizes[first]
        todo = [(b"", self.root.children.pop(first))]
        while todo:
            above, node = todo.pop()
            text = above + node.label
            if node.owner is not None:
                yield text, node.owner
            todo += [(text, child) for child in node.children.values()]

    def drain(self) -> Iterator[tuple[bytes, tuple[int | None, int]]]:
        while self.root.children or self.root.owner is not None:
            yield from self.spill()


def _lowered(column: pa.Array) -> list[bytes]:
    return [text.lower() for text in column.to_pylist()]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))


def exact_groups(docs: DataFrame, keep_largest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Every distinct text's digest with the doc_id that stays and the number of its rows.

    Columns n_bytes, text_sha256, keep_id, group_size.  A null text is empty.
    Null doc_ids count in group_size and stay only where a group has no other.
    """

    def rows(items: Iterator[tuple[bytes, tuple[int | None, int]]], bodies: bool) -> Iterator[pa.RecordBatch]:
        out, held = [], 0

        def sealed() -> pa.RecordBatch:
            texts = [text for text, _ in out]
            columns = {
                "n_bytes": pa.array(map(len, texts), pa.int64()),
                "keep_id": pa.array([o[0] for _, o in out], pa.int64()),
                "copies": pa.array([o[1] for _, o in out], pa.int64()),
            }
            if bodies:
                columns["body"] = pa.array(texts, pa.binary())
            else:
                columns["text_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            return pa.RecordBatch.from_pydict(columns)

        for text, owner in items:
            out.append((text, owner))
            held += len(text) + 64
            if held > 4 << 20:
                yield sealed()
                out, held = [], 0
        if out:
            yield sealed()
            out = []
        release_memory()

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, tuple[int | None, int]]]:
        trie = RadixTrie(keep_largest)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), _lowered(batch.column("text")), strict=True):
                    trie.insert(text, (doc_id, 1))
                while trie.bytes > trie_bytes:
                    yield from trie.spill()
        yield from trie.drain()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, tuple[int | None, int]]]:
        trie = RadixTrie(keep_largest)
        for whole in batches:
            for batch in small_batches(whole, "body"):
                columns = [batch.column(c).to_pylist() for c in ("body", "keep_id", "copies")]
                for text, keep, copies in zip(*columns, strict=True):
                    trie.insert(text, (keep, copies))
                while trie.bytes > trie_bytes:
                    yield from trie.spill()
        yield from trie.drain()

    local = _texts(docs).mapInArrow(
        lambda b: rows(collapse(b), True), "n_bytes long, keep_id long, copies long, body binary"
    )
    owned = local.repartition("n_bytes", F.xxhash64("body")).mapInArrow(
        lambda b: rows(own(b), False), "n_bytes long, keep_id long, copies long, text_sha256 string"
    )
    best = F.max("keep_id") if keep_largest else F.min("keep_id")
    return owned.groupBy("n_bytes", "text_sha256").agg(best.alias("keep_id"), F.sum("copies").alias("group_size"))


def exact_dedup(docs: DataFrame, keep_largest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Repeated doc_ids give a row each; rows of a group that share the doc_id
    that stays are all ``kept``.  ``kept`` of a null doc_id is true where
    the whole group has none.  An empty table gives no rows.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                texts = _lowered(batch.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n_bytes": pa.array(map(len, texts), pa.int64()),
                        "text_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    }
                )

    each = _texts(docs).mapInArrow(digests, "doc_id long, n_bytes long, text_sha256 string")
    groups = exact_groups(docs, keep_largest, trie_bytes)
    return each.join(groups, ["n_bytes", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, keep_largest: bool = True) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are.

    Rows that are equal in doc_id and text, too, leave one; which of them is open.
    """

    @F.arrow_udf("string")
    def digest(text: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(t.as_py().lower()).hexdigest() for t in text], pa.string())

    # of a deterministic key a join also wants to know that it is not null, and works it out for that
    # alone: in each task a second worker, which lives on, would see every text
    digest = digest.asNondeterministic()

    def key(c: str):
        return F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63)))

    groups = exact_groups(docs, keep_largest)
    stays = groups.select(key("keep_id").alias("_key"), F.col("text_sha256").alias("_digest"))
    marked = docs.withColumn("_key", key("doc_id")).withColumn("_digest", digest(whole_text().cast("binary")))
    kept = marked.join(stays, ["_key", "_digest"], "left_semi").dropDuplicates(["_key", "_digest"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
