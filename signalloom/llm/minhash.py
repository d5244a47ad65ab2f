"""Operator 2: near duplicates by one-permutation hashing.

The distinct 5-word shingles of a text are hashed once.  The top bits of a hash
choose one of ``BINS`` bins, each keeps its smallest hash, and an empty bin
borrows from a bin that a fixed random walk finds (optimal densification).  Sets
too small to fill the bins use as many separate permutations instead, so short
texts are found as surely.  Rows of the signature form bands, bands form
buckets.

A bucket gives star edges, each member to one hub, so pairs grow with members
and not with their square.  Links are confirmed on the full shingle sets.  A
member that its hub did not link may still belong to another member.  For the
buckets whose members are not all in one component, the shingles that no other
such text has are counted: a text links with nothing if more than a quarter of
its own are, and with no text that its other shingles are too few for.  That
settles copies edited too far.  What is left gets further hubs, those with the
fewest shingles of their own first and many more each round, until
every such member has met the others.

Texts with equal shingle sets are one class from the start and meet as one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import marked, release_memory, small_batches, whole_text
from signalloom.llm.components import connected_components
from signalloom.sources.scratch import materialize

WORDS = 5
PERCENT = 75
BINS, ROWS = 128, 4
#: Sets up to this size use permutations; sets above 0.75 of it use bins, too,
#: so that two sets of a link always share one kind of signature.
SMALL_SET = 128
FIRST_HUBS, HUB_GROWTH = 32, 256
#: 64 positions of an odd sketch each.
SKETCH = [f"odd_{i}" for i in range(16)]

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: A word's hash is its value as a polynomial modulo two primes: unlike powers of
#: two, they leave no pairs of words that every such hash takes for one.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_103_515_245, 845_564_101)
_PIECE = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base * base and so on, modulo the prime."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), int(_PRIME)))
        out = np.concatenate([out, out * step % _PRIME])
    return out[:n].astype(np.uint32)


class _Hasher:
    """Word hashes of many texts in one sweep over their bytes, piece by piece."""

    def __init__(self) -> None:
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []

    def _sums(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, which: int) -> np.ndarray:
        up, down = self.tables[which]
        # terms are below 2^31, so their sums stay exact
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)] % _PRIME, out=sums[1:])
        return (sums[last] - sums[first]) % _PRIME * down[first] % _PRIME

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words of bytes that end with a blank."""
        if not self.tables or len(self.tables[0][0]) < len(data) + 1:
            n = max(len(data) + 1, _PIECE)
            self.tables = [(_powers(base, n), _powers(pow(base, -1, int(_PRIME)), n)) for base in _BASES]
        edge = np.diff(np.concatenate([[True], _BLANK[data]]).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        high, low = (self._sums(data, first, last, which) for which in (0, 1))
        return first, _mix(_mix((high << np.uint64(32)) + low) + (last - first).astype(np.uint64))

    def words(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        firsts, hashes, start = [], [], 0
        while start < len(data):
            end = min(start + _PIECE, len(data))
            while not _BLANK[data[end - 1]]:  # a word is not cut
                ahead = np.flatnonzero(_BLANK[data[end : end + _PIECE]])
                end += int(ahead[0]) + 1 if len(ahead) else min(_PIECE, len(data) - end)
            first, found = self._piece(data[start:end])
            firsts.append(first + start)
            hashes.append(found)
            start = end
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.split(np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), ends[:-1]))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of all words together if they are few."""
    n = len(words)
    if n == 0:
        return words
    span = max(1, n - WORDS + 1)
    total = np.zeros(span, np.uint64)
    for k in range(min(WORDS, n)):
        total = _mix(total + words[k : k + span]) + np.uint64(k + 1)
    return np.unique(_mix(total + np.uint64(min(WORDS, n))))


def _walks() -> np.ndarray:
    """Where an empty bin looks, attempt by attempt; the same for all texts."""
    rng = np.random.default_rng(20_240_117)
    return rng.integers(0, BINS, (64 * BINS, BINS)).astype(np.uint8)


_WALKS = _walks()
_FACTORS = np.random.default_rng(77).integers(1, 1 << 63, (BINS, 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def one_permutation(hashes: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin, empty bins densified."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    at = np.searchsorted(hashes, edges)
    after = np.append(at[1:], len(hashes))
    full = after > at
    out = np.zeros(BINS, np.uint64)
    out[full] = hashes[at[full]]
    empty = np.flatnonzero(~full)
    for walk in _WALKS:
        if not len(empty):
            break
        source = walk[empty]
        hit = full[source]
        out[empty[hit]] = out[source[hit]]
        empty = empty[~hit]
    if len(empty):  # the walks of all attempts missed the full bins
        out[empty] = hashes[0]
    return out


def permutations(hashes: np.ndarray) -> np.ndarray:
    """Smallest value under each of ``BINS`` permutations."""
    return _mix(hashes[None, :] * _FACTORS).min(axis=1)


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for each band of each signature that sets of this size use."""
    kinds = []
    if len(hashes) <= SMALL_SET:
        kinds.append((1, permutations(hashes)))
    if len(hashes) * 100 > SMALL_SET * PERCENT:
        kinds.append((2, one_permutation(hashes)))
    keys = []
    for kind, signature in kinds:
        total = np.arange(BINS // ROWS, dtype=np.uint64) * np.uint64(4) + np.uint64(kind)
        for row in signature.reshape(-1, ROWS).T:
            total = _mix(total + row)
        keys.append(total)
    return np.concatenate(keys).view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Sorted distinct hashes with 100 * intersection >= 75 * union."""
    small, large = sorted((a, b), key=len)
    if 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Words of a bitmap of the positions that an odd number of the hashes have."""
    size = 64 * len(SKETCH)
    odd = np.bincount((_mix(hashes) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``tie``, a digest that tells texts of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text")).withColumn("tie", F.unhex(F.md5("text")))


def shingled(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_shingles, node (digest of the shingle set), keys of its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for whole in batches:
            for batch in small_batches(whole, "text", 1 << 20):
                sets = [shingle_set(w) for w in hasher.words([t.lower() for t in batch.column("text").to_pylist()])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"),
                        "tie": batch.column("tie"),
                        "n_shingles": pa.array(map(len, sets), pa.int64()),
                        "node": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        "keys": pa.array([band_keys(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    }
                )
        release_memory()

    return _keyed(docs).mapInArrow(run, "doc_id long, tie binary, n_shingles long, node binary, keys array<long>")


def _packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and packed text of ``wanted`` (node, doc_id, tie).

    The documents are read again for it, so that only these texts are written;
    most others are left out before they are packed or shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for batch in small_batches(whole, "text", 1 << 20):
                packed = pa.array([pack(t.lower()) for t in batch.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_pydict({"own_id": batch.column("doc_id"), "own_tie": batch.column("tie"), "packed": packed})
        release_memory()

    some = marked(_keyed(docs), F.xxhash64("tie"), wanted, F.xxhash64("tie"))
    packed = some.mapInArrow(run, "own_id long, own_tie binary, packed binary")
    found = packed.join(wanted, (F.col("own_tie") == F.col("tie")) & F.col("own_id").eqNullSafe(F.col("doc_id")))
    return found.groupBy("node").agg(F.first("packed").alias("packed"))  # equal rows


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, unpack = _Hasher(), zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in small_batches(whole, "a_packed", 1 << 18):
                # pairs with one hub come in runs: its text is hashed once
                left = batch.column("b_packed").to_pylist()
                sets: dict[bytes, np.ndarray] = {}
                right = batch.column("a_packed").to_pylist()
                for packed in {*left, *right}:
                    sets[packed] = shingle_set(hasher.words([unpack(packed)])[0])
                keep = pa.array([similar(sets[x], sets[y]) for x, y in zip(right, left, strict=True)])
                yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(keep) for c in ("a", "b")})
        release_memory()

    one = texts.select(F.col("node").alias("a"), F.col("packed").alias("a_packed"))
    two = texts.select(F.col("node").alias("b"), F.col("packed").alias("b_packed"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "a_packed", "b_packed").mapInArrow(check, "a binary, b binary")


def _common_shingles(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and ``common``: how many of its shingles another of ``nodes`` has, too."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, unpack = _Hasher(), zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in small_batches(whole, "packed", 1 << 18):
                sets = [shingle_set(w) for w in hasher.words([unpack(p) for p in batch.column("packed").to_pylist()])]
                ids = [int.from_bytes(n[:8], "big", signed=True) for n in batch.column("node").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(np.repeat(np.array(ids, np.int64), [len(x) for x in sets])),
                        "shingle": pa.array(np.concatenate(sets).view(np.int64)),
                    }
                )
        release_memory()

    wanted = texts.join(nodes, "node", "left_semi").select("node", "packed")
    # ids are cut digests: should two texts share one, both seem to have more in common
    each = wanted.mapInArrow(hashes, "id long, shingle long")
    own = each.groupBy("shingle").agg(F.count("*").alias("texts"), F.first("id").alias("id")).where("texts = 1")
    own = own.groupBy("id").agg(F.count("*").alias("own"))
    named = nodes.select("node", "n", F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long").alias("id"))
    return named.join(own, "id", "left").select("node", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common"))


def _sketches(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and the words of the odd sketch of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, unpack = _Hasher(), zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in small_batches(whole, "packed", 1 << 18):
                words = hasher.words([unpack(p) for p in batch.column("packed").to_pylist()])
                odd = np.array([odd_sketch(shingle_set(w)) for w in words]).reshape(-1, len(SKETCH))
                columns = {c: pa.array(odd[:, i]) for i, c in enumerate(SKETCH)}
                yield pa.RecordBatch.from_pydict({"node": batch.column("node")} | columns)
        release_memory()

    wanted = texts.join(nodes, "node", "left_semi").select("node", "packed")
    return wanted.mapInArrow(run, ", ".join(["node binary", *[f"{c} long" for c in SKETCH]]))


def _star_pairs(members: DataFrame, above: int, up_to: int) -> DataFrame:
    """Pairs of hubs, by rank in their bucket, with the members after them in other components.

    ``members``: key, node, n, common, hub, label, rank and the sketch.  Left out
    are pairs with the first hub, which everyone has met, and pairs that sizes,
    common shingles or sketches rule out as links.
    """
    hubs = members.where((F.col("rank") > above) & (F.col("rank") <= up_to) & (F.col("node") != F.col("hub"))).select(
        "key", *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "common", "label", "rank", *SKETCH)]
    )
    needed = PERCENT * (F.col("n") + F.col("b_n"))
    # shingles that one of the two texts has alone, at least
    apart = reduce(add, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH])
    fits = (
        (F.col("rank") > F.col("b_rank"))
        & (F.col("label") != F.col("b_label"))
        & (F.col("node") != F.col("hub"))
        & (100 * F.col("n") >= PERCENT * F.col("b_n"))
        & (100 * F.col("b_n") >= PERCENT * F.col("n"))
        & ((100 + PERCENT) * F.least("common", "b_common") >= needed)
        & ((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("n") + F.col("b_n")))
    )
    return members.join(hubs, "key").where(fits).select(F.col("node").alias("a"), F.col("b_node").alias("b")).distinct()


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _split_keys(labelled: DataFrame, most_met: int) -> DataFrame:
    """Keys of the buckets that span components and have hubs to come."""
    split = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    return split.where((F.col("low") != F.col("high")) & (F.col("size") > most_met)).select("key")


def _not_in_one(members: DataFrame, labels: DataFrame, most_met: int) -> DataFrame:
    """``members`` of those buckets, with their labels."""
    labelled = _labelled(members, labels)
    return labelled.join(_split_keys(labelled, most_met), "key")


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tie, n_shingles, node), and (node, component_id, stays) of nodes with shingles.

    ``component_id`` is the smallest doc_id of a component, ``stays`` the row
    (missing, doc_id, tie) that comes first in it.
    """
    table = materialize(shingled(docs), "shingled")
    some = table.where("n_shingles > 0")
    here = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tie")
    classes = some.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    owners = materialize(some.groupBy("node").agg(F.min(here).alias("owner")), "owners")
    exploded = materialize(classes.select("node", "n", F.explode("keys").alias("key")), "buckets")
    # most keys are in one text only: they are found by keys and counts, without nodes
    shared = exploded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    together = materialize(exploded.join(shared, "key", "left_semi"), "together")
    members = materialize(together.join(together.groupBy("key").agg(F.min("node").alias("hub")), "key"), "members")
    wanted = owners.join(members.select("node").distinct(), "node").select("node", "owner.doc_id", "owner.tie")
    texts = materialize(_packed_texts(docs, materialize(wanted, "wanted")), "texts")

    first = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = materialize(_confirm(first, texts), "near-links")
    labels = connected_components(links)
    unsettled = materialize(_not_in_one(members, labels, 2).drop("label"), "unsettled")
    common = _common_shingles(unsettled.select("node", "n").distinct(), texts)
    unsettled = unsettled.join(common, "node").where(100 * F.col("common") >= PERCENT * F.col("n"))
    unsettled = materialize(unsettled, "unsettled")
    sketches = materialize(_sketches(unsettled.select("node").distinct(), texts), "sketches")
    # a text with few shingles of its own is close to what its copies were made from
    central_first = Window.partitionBy("key").orderBy(F.desc(F.col("common") / F.col("n")), "node")
    met, up_to = 0, FIRST_HUBS
    while True:
        ranked = _not_in_one(unsettled, labels, met + 1).withColumn("rank", F.row_number().over(central_first))
        pairs = materialize(_star_pairs(ranked.join(sketches, "node"), met, up_to), "star-pairs")
        if pairs.limit(1).count():
            more = materialize(_confirm(pairs, texts), "near-links")
            if more.limit(1).count():
                # a star per component says as much as its links
                stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
                labels = connected_components(stars.union(more))
        met, up_to = up_to, up_to * HUB_GROWTH
        if _split_keys(_labelled(unsettled, labels), met + 1).limit(1).count() == 0:
            break

    # joined node by node, so that many copies of one text are rows of one plain join
    placed = owners.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "owner")
    placed = materialize(placed, "placed")
    first_of = materialize(placed.groupBy("label").agg(F.min("owner").alias("stays")), "components")
    found = placed.join(first_of, "label").select("node", F.col("stays.doc_id").alias("component_id"), "stays")
    return table.select("doc_id", "tie", "n_shingles", "node"), materialize(found, "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but blanks, A-Z lowered.  Texts without words,
    nulls included, have no shingles and link with nothing.  ``component_id`` is
    the smallest doc_id of those linked with the document, directly or over
    others.  Documents without doc_id take part; their component_id is null
    only if no member has one.  Rows with the same doc_id are documents of
    their own.  Shingles are compared by 62-bit hashes of their words.
    """
    rows, components = _components(docs)
    found = rows.join(components.select("node", "component_id"), "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, one without only if no member has one.

    Of several texts with this doc_id the one with the smallest digest stays, of
    rows equal in doc_id and text any.  Texts without words all stay.  All
    columns are kept as they are.
    """
    rows, components = _components(docs)
    alone = rows.where("n_shingles = 0").select("doc_id", "tie").distinct()
    twice = rows.where("n_shingles > 0").groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where("n > 1")
    stays = components.select("stays.doc_id", "stays.tie").distinct()
    same = stays["doc_id"].eqNullSafe(twice["doc_id"]) & (stays["tie"] == twice["tie"])
    stays = stays.join(twice, same, "left").select(stays["doc_id"], stays["tie"], F.col("n").isNotNull().alias("again"))
    stays = stays.union(alone.withColumn("again", F.lit(False)))
    stays = materialize(stays.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "again"), "stays")
    keyed = docs.withColumns({"__own_id": F.col("doc_id").cast("long"), "__own_tie": F.unhex(F.md5(whole_text().cast("binary")))})
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def of(kept: DataFrame) -> DataFrame:
        return keyed.join(kept, F.col("__own_id").eqNullSafe(F.col("__id")) & (F.col("__own_tie") == F.col("__tie")), "left_semi")

    out = of(stays.where("not again")).select(*columns)
    again = stays.where("again")
    if again.isEmpty():
        return out
    return out.union(of(again).dropDuplicates(["__own_id", "__own_tie"]).select(*columns))
