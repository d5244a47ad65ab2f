"""Encrypted table snapshots.

A snapshot is a set of artifacts, one per chunk of rows:

    magic (8 bytes) | IV (12) | AES-256-GCM ciphertext | tag (16)

The plaintext of a chunk is a gzip of an Arrow stream, so a restored table has
exactly the types of the original.  Compression runs in Arrow batches, as there
is no built-in for it; encryption, hashing and all checks run in the JVM.  The
key reaches the executors as a one-row table and is never part of a plan.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.hashing import KEY_PATTERN
from signalloom.limits import ARTIFACT_MAGIC, HEADER_BYTES, TAG_BYTES
from signalloom.operators.ordered import number_rows
from signalloom.sources.scratch import materialize

CHUNK_BYTES = 64 * 1024 * 1024
TREE_WIDTH = 256
#: Digest of a snapshot without chunks.
NO_CHUNKS = hashlib.sha256(b"").hexdigest()
GZIP_LEVEL = 6
_KEY = re.compile(KEY_PATTERN.replace(r"\z", r"\Z"))
_CHUNK = "snapshot_id string, key_id string, chunk_id string, n_rows long, raw_bytes long, gz binary"


class InvalidKey(ValueError):
    def __init__(self) -> None:
        super().__init__("the encryption key must be 64 hexadecimal digits (32 bytes)")


class SnapshotError(ValueError):
    pass


def parse_key(key_hex: str | None) -> bytes:
    """No key or a malformed one: refuse, never go on in plaintext."""
    if not isinstance(key_hex, str) or not _KEY.match(key_hex):
        raise InvalidKey
    return bytes.fromhex(key_hex)


def fingerprint(key_hex: str) -> str:
    return hashlib.sha256(parse_key(key_hex)).hexdigest()[:16]


def _with_key(df: DataFrame, key_hex: str, content: str) -> DataFrame:
    """Adds the key as ``__key``, from a one-row table rather than as a literal.

    The key id is named by an expression over the content: a constant would be
    folded and turn the equi-join into a nested loop.
    """
    key_id = fingerprint(key_hex)
    row = [(key_id, bytearray(parse_key(key_hex)))]
    keys = F.broadcast(df.sparkSession.createDataFrame(row, "__kid string, __key binary"))
    named = df.withColumn("__try", F.when(F.coalesce(F.octet_length(content), F.lit(0)) >= 0, F.lit(key_id)))
    return named.join(keys, F.col("__try") == F.col("__kid"), "left").drop("__try", "__kid")


def seal(df: DataFrame, key_hex: str, content: str = "gz") -> DataFrame:
    """``content`` encrypted, as ``artifact`` in its place."""
    sealed = F.concat(F.lit(bytearray(ARTIFACT_MAGIC)), F.aes_encrypt(content, "__key", F.lit("GCM")))
    return _with_key(df, key_hex, content).withColumn("artifact", sealed).drop(content, "__key")


def _slices(batch: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``max_bytes`` (one row at least), without copying."""
    pieces = max(1, -(-batch.nbytes // max_bytes))
    step = max(1, -(-batch.num_rows // pieces))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def build_artifacts(
    df: DataFrame, key_hex: str, snapshot_id: str, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The rows of ``df`` as encrypted artifacts.

    Each task cuts its own rows into chunks; nothing is shuffled.  The IV is
    random, so write the result before using it twice (``write_encrypted_snapshot``).
    """
    key_id = fingerprint(key_hex)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            raw = io.BytesIO()
            with pa.ipc.new_stream(raw, held[0].schema) as stream:
                for b in held:
                    stream.write_batch(b)
            plain = raw.getvalue()
            n = sum(b.num_rows for b in held)
            row = [snapshot_id, key_id, f"{part:06d}-{number:06d}", n, len(plain), gzip.compress(plain, GZIP_LEVEL, mtime=0)]
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            names = ["snapshot_id", "key_id", "chunk_id", "n_rows", "raw_bytes", "gz"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        size = 0
        for batch in batches:
            for part_of in _slices(batch, chunk_bytes):
                if held and size + part_of.nbytes > chunk_bytes:
                    yield chunk()
                    held, size, number = [], 0, number + 1
                held.append(part_of)
                size += part_of.nbytes
        if held:
            yield chunk()

    return seal(df.mapInArrow(pack, _CHUNK), key_hex)


def manifest_of(artifacts: DataFrame) -> DataFrame:
    """Per artifact: checksum and size of the whole artifact."""
    return artifacts.select(
        *[c for c in artifacts.columns if c != "artifact"],
        F.sha2("artifact", 256).alias("checksum"),
        F.octet_length("artifact").cast("long").alias("size_bytes"),
    )


def hash_tree(manifest: DataFrame) -> DataFrame:
    """(snapshot_id, level, no, hash): a tree of hashes over the chunks of each snapshot, in order of their names.

    Level 0 has a hash per chunk, of its name, rows, size and checksum; each node
    above hashes its ``TREE_WIDTH`` children in order, so that a repeated, missing
    or exchanged chunk changes every node over it.  A node is made from few
    rows, so no task holds all chunks.
    """
    leaf = F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("chunk_id", "n_rows", "size_bytes", "checksum")]), 256)
    named = manifest.select("snapshot_id", "chunk_id", "checksum", leaf.alias("hash"))
    numbered = number_rows(named, "snapshot_id", ("chunk_id", "checksum"), name="__no")
    level = materialize(numbered.select("snapshot_id", F.lit(0).alias("level"), (F.col("__no") - 1).alias("no"), "hash"), "leaves")
    levels, above = [level], 0
    while not level.where("no > 0").isEmpty():
        above += 1
        children = F.array_sort(F.collect_list(F.struct("no", "hash")))
        groups = level.groupBy("snapshot_id", F.floor(F.col("no") / TREE_WIDTH).alias("no")).agg(children.alias("__c"))
        node = F.sha2(F.array_join("__c.hash", ""), 256)
        level = materialize(groups.select("snapshot_id", F.lit(above).alias("level"), "no", node.alias("hash")), "nodes")
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def tree_roots(manifest: DataFrame) -> DataFrame:
    """(snapshot_id, digest): the root of each snapshot's tree."""
    nodes = hash_tree(manifest)
    tops = nodes.groupBy("snapshot_id").agg(F.max_by("hash", "level").alias("digest"))
    return tops.select("snapshot_id", "digest")


def verify_manifest(manifest: DataFrame, run: DataFrame) -> DataFrame:
    """``run`` (snapshot_id, digest and more) with ``manifest_status``: ok, or root_mismatch if the manifest is another."""
    found = tree_roots(manifest).withColumnRenamed("digest", "__found")
    same = F.col("digest") == F.coalesce("__found", F.lit(NO_CHUNKS))
    return run.join(found, "snapshot_id", "left").withColumn("manifest_status", F.when(same, "ok").otherwise("root_mismatch")).drop("__found")


def artifact_size_gate(manifest: DataFrame, max_mb: int | Column, snapshots: DataFrame | None = None) -> DataFrame:
    """One row per snapshot; FAILED if its ciphertext is over the limit.

    Headers and tags do not count.  ``digest`` is the root of the tree of hashes
    over all chunks.  ``snapshots`` (snapshot_id) names those that were taken, so
    that one without any chunk has its row too.
    """
    limit = F.greatest(F.lit(1), max_mb if isinstance(max_mb, Column) else F.lit(max_mb)).cast("long") * (1 << 20)
    out = manifest.groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("size_bytes").alias("size_bytes"),
        F.sum(F.col("size_bytes") - (HEADER_BYTES + TAG_BYTES)).alias("ciphertext_bytes"),
    )
    out = out.join(tree_roots(manifest), "snapshot_id")
    if snapshots is not None:
        out = snapshots.select("snapshot_id").distinct().join(out, "snapshot_id", "left")
    counts = ("n_chunks", "n_rows", "size_bytes", "ciphertext_bytes")
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts})
    over = F.col("ciphertext_bytes") > limit
    return out.select(
        "snapshot_id",
        *counts,
        F.coalesce("digest", F.lit(NO_CHUNKS)).alias("digest"),
        F.when(over, "FAILED").otherwise("UPLOADED").alias("run_status"),
        F.when(over, F.concat(F.lit("artifact over the limit of "), limit.cast("string"), F.lit(" bytes"))).alias("error"),
    )


def open_artifacts(artifacts: DataFrame, key_hex: str) -> DataFrame:
    """Adds ``opened`` (authenticated content or null) and ``artifact_status``.

    Every artifact is tried with the given key, whatever key id it names.
    """
    magic = len(ARTIFACT_MAGIC)
    keyed = _with_key(artifacts, key_hex, "artifact")
    whole = F.octet_length("artifact") >= HEADER_BYTES + TAG_BYTES
    body = F.when(whole, F.substring("artifact", magic + 1, 2**31 - 1))
    opened = keyed.withColumn("opened", F.try_aes_decrypt(body, "__key", F.lit("GCM")))
    return opened.withColumn("artifact_status", artifact_status("artifact", F.col("opened"))).drop(
        "__key"
    )


def artifact_status(artifact: Column | str, opened: Column) -> Column:
    """Why an artifact cannot be restored, or ``ok``.

    ``opened`` is the decrypted content, null if authentication failed; a
    wrong key and changed bytes cannot be told apart.
    """
    a = F.col(artifact) if isinstance(artifact, str) else artifact
    magic, n = len(ARTIFACT_MAGIC), F.octet_length(a)
    return (
        F.when(n.isNull() | (n < HEADER_BYTES), "short_header")
        .when(F.substring(a, 1, magic) != F.lit(bytearray(ARTIFACT_MAGIC)), "foreign_magic")
        .when(n < HEADER_BYTES + TAG_BYTES, "missing_tag")
        .when(opened.isNull(), "authentication_failed")
        .otherwise("ok")
    )


def check_against_manifest(artifacts: DataFrame, manifest: DataFrame) -> None:
    """Raises unless the artifacts are exactly those of the manifest, each once, byte for byte.

    Only names and checksums are compared, before anything is opened.
    """
    key = ["snapshot_id", "chunk_id", "checksum"]
    stored = artifacts.select("snapshot_id", "chunk_id", F.sha2("artifact", 256).alias("checksum"))
    stored = stored.groupBy(*key).agg(F.count(F.lit(1)).alias("__stored"))
    listed = manifest.groupBy(*key).agg(F.count(F.lit(1)).alias("__listed"))
    both = stored.join(listed, key, "full")
    fault = F.when(F.col("__listed").isNull(), "foreign").when(F.col("__stored").isNull(), "missing").when(F.col("__stored") > 1, "repeated")
    first = both.select(fault.alias("fault"), "snapshot_id", "chunk_id").where("fault is not null").orderBy(F.desc("fault"), "chunk_id").first()
    if first is not None:
        raise SnapshotError(f"{first['fault']} chunk {first['chunk_id']} of {first['snapshot_id']}")


def restore_artifacts(
    artifacts: DataFrame, key_hex: str, schema: T.StructType, manifest: DataFrame | None = None
) -> DataFrame:
    """The rows of a snapshot.  One artifact that cannot be restored fails the job.

    With its manifest a missing, repeated, changed or foreign chunk is refused
    before anything is opened, so that a restore is never partial.
    """
    if manifest is not None:
        check_against_manifest(artifacts, manifest)
    reason = F.concat(F.lit("artifact "), F.coalesce("chunk_id", F.lit("?")), F.lit(": "), F.col("artifact_status"))
    checked = open_artifacts(artifacts, key_hex).select(
        F.when(F.col("artifact_status") == "ok", F.col("opened")).otherwise(F.raise_error(reason)).alias("gz")
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                with pa.ipc.open_stream(gzip.decompress(value.as_py())) as stream:
                    yield from stream

    return checked.mapInArrow(unpack, schema)


@F.arrow_udf(T.LongType())
def _plain_bytes(gz: pa.Array) -> pa.Array:
    """Sizes one by one, so that a batch is held in memory once."""

    def size(data: bytes | None) -> int | None:
        if data is None:
            return None
        try:
            return len(gzip.decompress(data))
        except (OSError, EOFError):
            return None

    return pa.array((size(data.as_py()) for data in gz), pa.int64())


def verify_artifacts(artifacts: DataFrame, key_hex: str, manifest: DataFrame | None = None) -> DataFrame:
    """Restore without writing; one row per artifact, also for broken ones.

    With a manifest, a checksum that differs is an error, chunks that it does not
    list, or lists under another snapshot, are ``not_in_manifest``, further copies
    of a chunk ``repeated``, and chunks that are not there come out as ``missing``.
    """
    done = open_artifacts(artifacts, key_hex).select(
        "snapshot_id",
        "chunk_id",
        F.sha2("artifact", 256).alias("checksum"),
        F.octet_length("artifact").cast("long").alias("size_bytes"),
        _plain_bytes("opened").alias("plaintext_bytes"),
        "artifact_status",
    )
    status = F.when(
        (F.col("artifact_status") == "ok") & F.col("plaintext_bytes").isNull(), "corrupt_content"
    ).otherwise(F.col("artifact_status"))
    done = done.withColumn("artifact_status", status)
    if manifest is None:
        return done
    want = manifest.select(
        F.col("snapshot_id").alias("__s"), F.col("chunk_id").alias("__c"), F.col("checksum").alias("__sum")
    ).distinct()
    joined = done.join(want, (F.col("snapshot_id") == F.col("__s")) & (F.col("chunk_id") == F.col("__c")), "full")
    # the copy that is as listed counts, of equal ones the first
    good = (F.col("artifact_status") == "ok") & (F.col("__sum") == F.col("checksum"))
    copies = Window.partitionBy("__s", "__c").orderBy(F.coalesce(good, F.lit(False)).desc(), "checksum")
    numbered = joined.withColumn("__copy", F.when(F.col("__c").isNotNull(), F.row_number().over(copies)))
    return numbered.select(
        F.coalesce("snapshot_id", "__s").alias("snapshot_id"),
        F.coalesce("chunk_id", "__c").alias("chunk_id"),
        "checksum",
        "size_bytes",
        "plaintext_bytes",
        F.when(F.col("artifact_status").isNull(), "missing")
        .when(F.col("__copy") > 1, "repeated")
        .when((F.col("artifact_status") == "ok") & F.col("__sum").isNull(), "not_in_manifest")
        .when((F.col("artifact_status") == "ok") & (F.col("__sum") != F.col("checksum")), "checksum_mismatch")
        .otherwise(F.col("artifact_status"))
        .alias("artifact_status"),
    )
