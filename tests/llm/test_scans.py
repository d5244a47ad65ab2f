"""Operators 3, 5, 8 and 9: secrets, quality, personal data, fingerprints."""

import base64
import json
import re

import numpy as np
import pytest

from signalloom.llm import fingerprint, pii, queries, rules, secret_scan
from tests.llm import brute
from tests.llm.conftest import SF_DIR


def der(tag: int, body: bytes) -> bytes:
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82, size >> 8, size & 255])
    return bytes([tag]) + head + body


RSA = der(0x30, der(0x02, b"\0") + b"".join(der(0x02, bytes(range(1, 40))) for _ in range(8)))


def b64url(data) -> str:
    return base64.urlsafe_b64encode(json.dumps(data).encode()).decode().rstrip("=")


def test_secrets(case):
    docs, pairs = case
    got = {r["doc_id"]: r for r in secret_scan.secret_digests(secret_scan.scan_secrets(docs)).collect()}
    assert len(got) == len(pairs)
    for doc_id, text in pairs:
        want, r = brute.secrets(text), got[doc_id]
        assert r["base_sha256"] == brute.sha(brute.joined(want))
        kept = [s for s in r["spans"].split(",") if s.split(":")[0] in secret_scan.BASE_KINDS]
        assert ",".join(kept) == brute.joined(want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for *_, k in want) for x in secret_scan.BASE_KINDS)


def test_secrets_are_confirmed_by_structure():
    kinds = lambda t: [secret_scan.KINDS[k] for _, k, _ in secret_scan.find_spans(t)]
    good = f"{b64url({'alg': 'HS256'})}.{b64url({'sub': 1})}.c2ln"
    assert kinds(f"x {good} y") == ["token"]
    assert kinds(f"x {b64url({'typ': 'x'})}.{b64url({})}.aa") == [] and kinds("eyJhbGciOi.eyJ.x") == []
    assert kinds("eyJ" + "W" * 200_000 + ".eyJ9.x") == []
    body = base64.b64encode(RSA).decode()
    assert kinds(body) == ["key64"] and kinds(body[4:]) == [] and kinds(base64.b64encode(RSA + b"xxx").decode()) == []
    assert "keyhex" in kinds(RSA.hex())
    lines = "\n".join(re.findall(".{1,64}", body))
    assert "pem" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----")
    assert "pem" not in kinds("-----BEGIN RSA PRIVATE KEY-----\nAAAA\n-----END RSA PRIVATE KEY-----")
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b""))
    ssh += (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"k" * 50, b"p" * 90))
    assert secret_scan.is_openssh_key(ssh) and not secret_scan.is_openssh_key(ssh + b"x")
    assert kinds("token=abcdefghijklmnop") == ["assign"] and kinds("ToKen : 'abc'") == []


def test_secrets_in_other_wrappings():
    kinds = lambda t: [secret_scan.KINDS[k] for _, k, _ in secret_scan.find_spans(t)]
    wrap = lambda data, n=64: "\n".join(re.findall(f".{{1,{n}}}", base64.b64encode(data).decode()))
    pem = lambda name, body: f"-----BEGIN {name}-----\n{body}\n-----END {name}-----"
    pbes2 = der(0x06, bytes.fromhex("2a864886f70d01050d"))
    locked = der(0x30, der(0x30, pbes2 + der(0x30, b"")) + der(0x04, bytes(range(96))))
    assert kinds(pem("ENCRYPTED PRIVATE KEY", wrap(locked))) == ["pem"]
    digest = der(0x30, der(0x30, der(0x06, bytes.fromhex("608648016503040201")) + der(0x05, b"")) + der(0x04, bytes(32)))
    assert kinds(base64.b64encode(digest).decode()) == []
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0A" * 16 + "\n\n"
    assert "pem" in kinds(pem("RSA PRIVATE KEY", head + wrap(bytes(range(160)))))
    assert "pem" not in kinds(pem("RSA PRIVATE KEY", head + wrap(bytes(range(161)))))
    assert kinds(pem("RSA PRIVATE KEY", "Comment: mine\n\n" + wrap(RSA))) == ["pem"]
    for n in (64, 76):
        text = f"key:\n{wrap(RSA, n)}\nend"
        assert secret_scan.find_spans(text) == [(5, 5, len(text) - 4)]
    assert kinds(base64.b64encode(RSA).decode() + "\nend") == ["key64"] and kinds(wrap(RSA)[:-30]) == []


def test_account_numbers_in_groups(spark):
    texts = [
        "to DE89 3704 0044 0532 0130 00 PAID",
        "ES91 2100 0418 4502 0005 1332 PAID NOW",
        "DE89 3704 0044 0532 0130 01",
        "NO93 8601 1117 947, BE68 5390 0754 7034",
        "xDE89 3704 0044 0532 0130 00 and DE89370400440532013000",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith("iban")] for r in pii.personal_digests(docs).collect()}
    assert got == {0: ["iban:3:30"], 1: ["iban:0:29"], 2: [], 3: ["iban:0:18", "iban:20:39"], 4: ["iban:33:55"]}
    assert pii.mask_personal(docs).where("doc_id = 0").first()["text"] == "to [IBAN] PAID"


def test_personal(case):
    docs, pairs = case
    got = {r["doc_id"]: r for r in pii.personal_digests(docs).collect()}
    assert len(got) == len(pairs)
    for doc_id, text in pairs:
        want, r = brute.personal(text), got[doc_id]
        assert r["base_sha256"] == brute.sha(brute.joined(want)), text
        assert ",".join(s for s in r["spans"].split(",") if not s.startswith("iban")) == brute.joined(want)
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(k == x for *_, x in want) for k in pii.BASE_KINDS]


def test_personal_edges(spark):
    texts = [
        "a@b.c_x@d.e a@b.c@d.e",
        "4111-1111-1111-1111 4111111111111111  5500 0000 0000 0004",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 0.0.0.0",
        "x" * 100_000 + "@",
        "1 " * 30_000,
        "a@b" + ".c" * 30_000,
        "😀 a@b.cd 😀 +49 (30) 1234-5678 9",
        "pay DE89370400440532013000 not DE89370400440532013001",
        " ".join(f"u{i}@h.org" for i in range(700)),
    ]
    rows = pii.personal_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        spans = [s for s in r["spans"].split(",") if s and not s.startswith("iban")]
        assert ",".join(spans) == brute.joined(brute.personal(texts[r["doc_id"]]))
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["spans"] == "iban:4:26" and by_id[8]["n_email"] == 700


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([(1, "call +49 30 1234567"), (2, "sum +49 30 1234567")], "doc_id long, text string")
    scores = {r["doc_id"]: r["scores"] for r in pii.personal_digests(docs).collect()}
    assert scores == {1: "0.8", 2: "0.6"}


def test_masking_keeps_other_columns(spark, odd_docs):
    masked = pii.mask_personal(odd_docs)
    assert masked.schema == odd_docs.schema and masked.count() == odd_docs.count()
    docs = spark.createDataFrame([("mail a@b.4111 1111 1111 1111 now", 1), (None, 2)], "text string, doc_id long")
    assert [r["text"] for r in pii.mask_personal(docs).orderBy("doc_id").collect()] == ["mail [EMAIL] now", None]


def test_quality_is_learned(spark):
    got = queries.op5_quality_rules(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in got.collect())


def test_quality_of_odd_input(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(0, 1), (3, 0), (3, 0), (5, None), (None, 1)], "doc_id long, quality int")
    for docs in (odd_docs, empty_docs):
        scored = rules.score_quality(docs, rules.train(docs, labels))
        assert scored.count() == docs.count()
        assert scored.where("score is null or isnan(score) or predicted is null").count() == 0
    assert rules.train(odd_docs, labels.limit(0)).weighted == []


def test_rules_compile_to_what_they_mean(spark, odd_docs):
    x = np.random.default_rng(3).random((400, len(rules.STATISTICS)))
    y = ((x[:, 2] > 0.4) & (x[:, 5] <= 0.7)).astype(int)
    model = rules.fit_rules(x, y)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"_s_{s} double" for s in rules.STATISTICS))
    got = [r[0] for r in frame.select(model.score()).collect()]
    want = [model.intercept + sum(w for r, w in model.weighted if rules.holds(r, row[None])[0]) for row in x]
    assert np.allclose(got, 1 / (1 + np.exp(-np.array(want)))) and ((np.array(got) > 0.5) == y).mean() > 0.95
    assert len(model.describe()) == len(model.weighted) > 0


@pytest.mark.parametrize("ranges", [None, 3])
def test_fingerprints(case, ranges):
    docs, pairs = case
    got = {r["doc_id"]: r for r in fingerprint.edited_likeness(docs, ranges).collect()}
    ordered = sorted(pairs, reverse=True, key=lambda p: p[0])
    assert len(got) == len(ordered)
    for k, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(edited))
        assert r["fingerprint"] == fingerprint.fingerprint(text) and r["edited_fingerprint"] == fingerprint.fingerprint(edited)
        assert r["near_edited"] == fingerprint.likeness(fingerprint.fingerprint(text), fingerprint.fingerprint(edited))
        assert r["near_next"] == fingerprint.likeness(r["fingerprint"], fingerprint.fingerprint(after))
        assert 0 <= r["near_next"] <= 1


def test_fingerprints_tell_edits_from_strangers(spark):
    rows = queries.op9_fingerprints(spark, SF_DIR).where("n_chars > 1000").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.97 * len(rows)


def test_fingerprints_of_odd_input(spark, empty_docs):
    assert fingerprint.edited_likeness(empty_docs).count() == 0
    one = spark.createDataFrame([(9, "abcdef")], "doc_id long, text string")
    row = fingerprint.edited_likeness(one).first()
    assert row["edited_sha256"] == brute.sha("abcabc") and row["near_next"] == 1.0
    rows = [(2, "bb"), (2, "bb"), (2, "ccc"), (None, "n"), (1, None)]
    assert fingerprint.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).count() == 5
    assert fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).count() == 5


def test_very_many_lines_and_addresses_end_in_seconds(spark):
    """5 MB of base64 lines, 100,000 e-mail addresses; a key at the end of a block of lines is still found."""
    import base64
    import time

    from signalloom.llm import secret_scan as scan

    began = time.time()
    lines = "\n".join("M" + "Qx7A" * 15 + "abc" for _ in range(75_000))
    assert not [s for s in scan.find_spans(lines) if s[1] == 5]
    key = base64.b64encode(b"\x30\x82\x02\x58\x02\x01\x00" + b"\x02\x82\x02\x51" + bytes(range(1, 200)) * 3)[:804].decode()
    assert scan.der_size(base64.b64decode(key[:8])) == 604
    mail = spark.createDataFrame([(1, "a@b.cd, " * 100_000), (2, "é 4111111111111111 x@y.zz"), (3, None)], "doc_id long, text string")
    got = {r[0]: r[1] for r in pii.mask_personal(mail).collect()}
    assert got == {1: "[EMAIL], " * 100_000, 2: "é [CARD] [EMAIL]", 3: None}
    assert time.time() - began < 90
