"""Operator 3: secrets in texts, confirmed by their structure.

Three base kinds are plain patterns.  Four further kinds are reported only if
what the candidate encodes parses: signed tokens need a JSON header that names
an algorithm and a JSON body, private keys need nested lengths that fill their
container to the last byte, in PEM, bare base64 or hex.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import small_batches, whole_text

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "token", "pem", "key64", "keyhex")

# The patterns of the base kinds.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
MIN_ASSIGN, MIN_ACCESS = 12, 18

_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_HEADERS = r"(?:\r?\n[A-Za-z][A-Za-z0-9-]*: [^\r\n]*(?:\r?\n[\x20\t][^\r\n]*)*)*"
_PEM = re.compile(rf"-----BEGIN ([A-Z ]{{0,30}}PRIVATE KEY)-----({_HEADERS})([A-Za-z0-9+/=\s]+)-----END \1-----")
_CIPHER = re.compile(r"\nDEK-Info: (?:DES|AES|CAMELLIA|RC2)[A-Z0-9-]*,((?:[0-9A-Fa-f]{16}){1,2})\s*(?:\n|\Z)")
_MORE64 = re.compile(r"\r?\n([A-Za-z0-9+/]+={0,2})(?![A-Za-z0-9+/=])")
_RUN64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
_RUNHEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff])[0-9A-Fa-f]{62,}(?![0-9A-Fa-f])")
_OPENSSH = b"openssh-key-v1\x00"
#: Identifiers of password-based encryption (PKCS #5 and #12), as encoded.
_ENCRYPTIONS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def from_base64(text: str, alphabet: str = "+/") -> bytes | None:
    body = re.sub(r"\s", "", text).rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), altchars=alphabet.encode(), validate=True)
    except (binascii.Error, ValueError):
        return None


def tag_lengths(data: bytes) -> list[tuple[int, bytes]] | None:
    """The elements of a DER container's content; None unless they fill it exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """A sequence that starts with a small version number and holds a key's parts."""
    outer = tag_lengths(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = tag_lengths(outer[0][1])
    if not inner or len(inner) < 3 or inner[0][0] != 0x02 or len(inner[0][1]) != 1 or inner[0][1][0] > 3:
        return False
    tags = [tag for tag, _ in inner[1:]]
    numbers = all(tag == 0x02 for tag in tags) and len(tags) >= 5
    wrapped = tags[:2] == [0x30, 0x04] and tag_lengths(inner[1][1]) is not None
    curve = tags[0] == 0x04 and any(tag == 0xA0 for tag in tags)
    return numbers or wrapped or curve


def is_encrypted_key(data: bytes) -> bool:
    """A sequence of a password-based algorithm and the encrypted bytes."""
    outer = tag_lengths(data)
    inner = tag_lengths(outer[0][1]) if outer and len(outer) == 1 and outer[0][0] == 0x30 else None
    if not inner or [tag for tag, _ in inner] != [0x30, 0x04] or not inner[1][1]:
        return False
    algorithm = tag_lengths(inner[0][1])
    return bool(algorithm) and algorithm[0][0] == 0x06 and algorithm[0][1].startswith(_ENCRYPTIONS)


def is_openssh_key(data: bytes) -> bool:
    """Length-prefixed strings after the magic: cipher, kdf, options, keys, private part."""
    if not data.startswith(_OPENSSH):
        return False
    at, fields = len(_OPENSSH), 0
    while at < len(data):
        if fields == 3:
            at += 4  # number of keys
            fields += 1
            continue
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        fields += 1
    return at == len(data) and fields >= 6


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_encrypted_key(data) or is_openssh_key(data))


def is_pem_key(headers: str, body: str) -> bool:
    """The body is a key, or whole blocks of the cipher that the headers name."""
    data, cipher = from_base64(body), _CIPHER.search(headers)
    if data and cipher and "ENCRYPTED" in headers:
        return len(data) % (len(cipher[1]) // 2) == 0
    return is_key(data)


def der_size(head: bytes | None) -> int | None:
    """Bytes of the whole structure that begins with ``head``, as it says itself."""
    if not head or head[0] != 0x30 or len(head) < 5:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    n = head[1] & 0x7F
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if n <= 3 else None


class WrappedKeys:
    """Keys in lines of base64, all as long as the first, but for the last.

    The lines of a block are found once, and a start is decoded only where the
    size that it states is that of the rest of the block, so that a long block
    without a key costs one pass.
    """

    def __init__(self, text: str):
        self.text = text
        self.lines: list[tuple[int, int]] = []
        self.places: dict[int, int] = {}
        self.failed_until = 0

    def _block(self, start: int, end: int) -> int:
        """The place of the line in its block."""
        if self.places.get(start) is not None and self.lines[self.places[start]] == (start, end):
            return self.places[start]
        self.lines, width = [(start, end)], end - start
        while len(self.lines) == 1 or self.lines[-1][1] - self.lines[-1][0] == width:
            more = _MORE64.match(self.text, self.lines[-1][1])
            if not more or len(more[1]) > width:
                break
            self.lines.append((more.start(1), more.end()))
        self.places = {line[0]: i for i, line in enumerate(self.lines)}
        return 0

    def end_of(self, start: int, end: int) -> int | None:
        """Where a key ends that begins with the line from ``start`` to ``end`` and goes on in further lines."""
        openssh = self.text.startswith("b3Bl", start)
        if not openssh and not self.text.startswith("M", start):
            return None
        place = self._block(start, end)
        rest, width = self.lines[place + 1 :][-2:], end - start
        if openssh and start < self.failed_until:
            return None
        stated = der_size(from_base64(self.text[start : start + 8]))
        for line in reversed(rest):
            # lines before it are whole
            size = (self.places[line[0]] - place) * width + line[1] - line[0]
            size = size * 3 // 4 - self.text.count("=", line[1] - 2, line[1])
            if (openssh or stated == size) and is_key(from_base64(self.text[start : line[1]])):
                return line[1]
        if openssh:
            self.failed_until = self.lines[-1][1]
        return None


def is_signed_token(text: str) -> bool:
    head, body, _ = text.split(".")
    parsed = []
    for part in (head, body):
        raw = from_base64(part, "-_")
        try:
            parsed.append(json.loads(raw))
        except (TypeError, ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parsed) and isinstance(parsed[0].get("alg"), str)


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every secret, in code points, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "eyJ" in text:
        found += [(m.start(), 3, m.end()) for m in _SIGNED.finditer(text) if is_signed_token(m[0])]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), 4, m.end()) for m in _PEM.finditer(text) if is_pem_key(m[2], m[3])]
    blocks, after, wrapped = [(a, b) for a, k, b in found if k == 4], 0, WrappedKeys(text)
    for m in _RUN64.finditer(text):
        if m.start() < after:
            continue
        if is_key(from_base64(m[0])):
            found.append((m.start(), 5, m.end()))
        elif not any(a <= m.start() < b for a, b in blocks) and (end := wrapped.end_of(*m.span())):
            found.append((m.start(), 5, end))
            after = end
    found += [(m.start(), 6, m.end()) for m in _RUNHEX.finditer(text) if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0]))]
    return sorted(found)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and its secrets as ``array<struct<kind, start, end>>``, ends exclusive.

    One row per row of ``docs``; a null text is empty and has none; repeated
    rows give repeated results.  Only doc_id and text are read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for whole in batches:
            for batch in small_batches(whole, "text"):
                secrets = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find_spans(text)]
                    for text in batch.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(secrets, pa.list_(span))], names=["doc_id", "secrets"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(scan, "doc_id long, secrets array<struct<kind: string, start: bigint, end: bigint>>")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
