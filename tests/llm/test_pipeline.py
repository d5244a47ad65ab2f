"""The pipeline against a plain version of its stages."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from signalloom.llm import queries
from signalloom.sources.scratch import materialize
from tests.llm import brute
from tests.llm.conftest import SF_DIR


def masked(text: str) -> str:
    from signalloom.llm.pii import KINDS

    out, at = [], 0
    merged: list[list] = []
    for a, b, kind in brute.personal(text):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        assert kind in KINDS
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def expected(docs: list, rejected: set) -> dict[int, str]:
    kept = {d: t for d, t in docs if d not in rejected}
    last = {}
    for d in sorted(kept):
        last[brute.lowered(kept[d])] = d
    kept = {d: kept[d] for d in last.values()}
    near = brute.near_components(list(kept.items()))
    return {d: masked(kept[d] or "") for d in kept if near[d][1] == d}


def compare(rows, want: dict[int, str]) -> None:
    ids = {d: brute.ids_of(t) + [1] for d, t in want.items()}
    seen = {d: np.zeros(len(i), int) for d, i in ids.items()}
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == brute.crc(piece) and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]][r["start"] : r["start"] + r["length"]] += 1
    assert all((s == 1).all() for s in seen.values())


def test_pipeline(spark, pairs):
    rejected = {r["doc_id"] for r in queries.op5_quality_rules(spark, SF_DIR).where("predicted = 0").collect()}
    compare(corpus_pipeline.run(spark, SF_DIR).collect(), expected(pairs["documents"], rejected))


def test_stages_on_odd_documents(spark, odd_docs, empty_docs, pairs):
    want = expected(pairs["odd"], set())
    for docs, expect in ((odd_docs, want), (empty_docs, {})):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES[1:]:
            before, docs = docs, materialize(stage(spark, docs, SF_DIR), "stage")
            if name != "packing":
                assert docs.columns == before.columns
        compare(docs.collect(), expect)
        assert bool(expect) == (docs.count() > 0)


def test_all_stages_keep_columns_of_any_name(spark, odd_docs, documents):
    """Good documents among odd ones, with columns named as those that stages make."""
    names = ["score", "predicted", "_t", "_w", "_l", "_spans", "_hits", "_key", "_digest", "node", "tie", "other_columns", "n_chars"]
    docs = odd_docs.select("doc_id", "text").union(documents.select(F.col("doc_id") + 10_000, "text"))
    docs = docs.select("doc_id", *[F.lit(42.5 + i).alias(n) for i, n in enumerate(names)], "text")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF_DIR), "stage")
        if name != "packing":
            assert docs.columns == before.columns and docs.count() > 0
            kept = names if name != "personal data" else names[:-1]
            assert docs.where(" or ".join(f"`{n}` <> {42.5 + i}" for i, n in enumerate(names) if n in kept)).isEmpty()
    assert docs.count() > 0


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "B"), (None, "b"), (None, "c")], "doc_id long, text string")
    got = corpus_pipeline.drop_copies(spark, docs, SF_DIR).collect()
    groups = defaultdict(int)
    for r in got:
        groups[(r["doc_id"], r["text"].lower())] += 1
    assert groups == {(1, "a"): 1, (1, "b"): 1, (None, "c"): 1}
