"""Plain single-machine versions of what the corpus operators must return."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

from signalloom.llm.encoding import default_vocabulary, library

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def ids_of(text: str | None) -> list[int]:
    return library(default_vocabulary()).encode(text or "", add_special_tokens=False).ids


def decoded(ids: list[int]) -> str:
    return library(default_vocabulary()).decode(ids, skip_special_tokens=False)


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def luhn(s: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    t = text or ""
    found = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(t)]
    found += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [
        (m.start(), 2, m.end(), "card") for m in CARD.finditer(t) if 14 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))
    ]
    found += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(t) if 10 <= len(_digits(m[0])) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def secrets(text: str | None) -> list[tuple[int, int, str]]:
    t = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def shingles(text: str | None, n: int = 5) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id); every pair is compared through shared shingles."""
    sets = {d: shingles(t) for d, t in docs}
    above = {d: d for d in sets}

    def root(d):
        while above[d] != d:
            d = above[d]
        return d

    by_shingle = defaultdict(list)
    for d in sets:
        for s in sets[d]:
            by_shingle[s].append(d)
    for d in sets:
        shared = defaultdict(int)
        for s in sets[d]:
            for e in by_shingle[s]:
                if e < d:
                    shared[e] += 1
        for e, n in shared.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                above[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def repeated_bytes(docs: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple[int, int, int, str]]:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        data = (t or "").encode()
        mark = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                mark[i : i + length] = True
            else:
                seen.add(piece)
        removed = mark[:-1]
        spans = int((np.diff(np.concatenate([[0], removed.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~removed])
        out[d] = (len(data), int(removed.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out
