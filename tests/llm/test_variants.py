"""Operators 11, 12 and 13: benchmark passages, hard negatives, spelling variants."""

import re
import zlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalloom.llm import hard_negatives, positional_index, queries, spelling
from signalloom.llm.common import read_table
from tests.llm import brute
from tests.llm.conftest import SF_DIR
from tests.oracle import connect, difference

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall(low(text))
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[s : s + k])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = WORD.findall(low(text))
        hit, ids = set(), set()
        for k in lengths:
            for s in range(len(w) - k + 1):
                if found := windows.get(tuple(w[s : s + k])):
                    hit.update(range(s, s + k))
                    ids |= found
        out.append((doc_id, len(w), len(hit), len(ids), brute.sha(",".join(sorted(ids))), bool(hit)))
    return Counter(out)


def rows_of(df):
    return Counter(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()))


def test_contamination_has_sql(spark):
    con = connect(SF_DIR)
    sql = queries.ORACLE["op11_positional_index"]
    assert difference(queries.op11_positional_index(spark, SF_DIR), con, sql) is None


@pytest.mark.parametrize("bound", [100_000, 0])
def test_contamination(spark, rng, odd_texts, monkeypatch, bound):
    """Small and large tables of terms; overlaps, repeats, short items, odd ids and clashing columns."""
    if not bound:
        never = lambda *a, **b: False
        monkeypatch.setattr(positional_index, "fits_broadcast", never)
        monkeypatch.setattr(positional_index, "maybe_broadcast", lambda df, *a: df)
    words = ["a", "b", "c", "the", "ü", "x1"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 9, 10, 30, 200]))) for _ in range(80)]
    texts += odd_texts + ["a " * 300, "...a B c!", "THE the", "É é"]
    items = [(i, rng.choice(texts) or "x") for i in range(6)] + [(7, "a a a a a a a a a a a"), (7, "the b"), (None, "c"), (8, None), (9, ""), (10, "--")]
    items += [(20 + i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 10, 14])))) for i in range(12)]
    items += [(40, items[0][1]), (41, "\n".join(t for t in texts if t)[:4000])]
    docs = [(i % 90, t) for i, t in enumerate(texts)] + [(None, "the b c"), (None, None), (5, "the b")]
    docs_df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in docs], "doc_id long, text string, n_hit int, term string, item string").repartition(4)
    items_df = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, q int").repartition(2)
    assert rows_of(positional_index.find_contamination(docs_df, items_df)) == contamination(docs, items)
    if bound:
        assert rows_of(positional_index.find_contamination(docs_df, items_df, window=3)) == contamination(docs, items, 3)


def test_contamination_of_nothing(spark, empty_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert positional_index.find_contamination(empty_docs, items).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    got = positional_index.find_contamination(docs, items.limit(0)).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 2, 0, 0)]


def test_plan_has_no_python(spark, documents, tmp_path):
    df = positional_index.find_contamination(documents, read_table(spark, SF_DIR, "benchmark"))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_proximity(spark, rng, tmp_path):
    words = ["a", "b", "c", "d"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 20, 60]))) for _ in range(20)]
    wanted = ["a b", "c d a", "b", "zz a", "d d c"]
    index = positional_index.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(tmp_path / "index"))
    items = positional_index.item_texts(spark.createDataFrame([(t,) for t in wanted], "text string"))
    terms = positional_index.item_terms(items)
    for within in (2, 4):
        found = positional_index.proximity_matches(index, terms, within).join(items, "item").join(positional_index.indexed_documents(index), "row_no")
        got = Counter(map(tuple, found.select("text", "doc_id", "pos").collect()))
        want = Counter()
        for query in wanted:
            need = set(query.split())
            for d, text in enumerate(texts):
                w = text.split()
                for p in range(len(w)):
                    if w[p] in need and need <= set(w[p : p + within]):
                        want[query, d, p + 1] += 1
        assert got == want


def hard(rows, every=50, n_pos=5, n_neg=3):
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label  # as SQL does, below zero too
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        usable[i] = min(usable.get(i, row), row)
    out = set()
    for a, (la, va) in usable.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, vb)), b, lb) for b, (lb, vb) in usable.items() if b != a and len(va) == len(vb))
        for sp, p, _ in [s for s in scored if s[2] == la][:n_pos]:
            fits = [s for s in scored if s[2] != la and 50 * -sp <= 100 * -s[0] <= 95 * -sp][:n_neg]
            out |= {(a, p, r, b, -sp, -s) for r, (s, b, _) in enumerate(fits, 1)}
    return out


def mined(df):
    rows = df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert len(rows) == len(set(rows))
    return set(map(tuple, rows))


def test_negatives_have_sql(spark):
    con = connect(SF_DIR)
    assert difference(queries.op12_hard_negatives(spark, SF_DIR), con, queries.ORACLE["op12_hard_negatives"]) is None


@pytest.mark.parametrize("chunk_bytes", [hard_negatives.CHUNK_BYTES, 2000])
def test_negatives(spark, rng, chunk_bytes):
    """Ties, repeats, odd rows, several lengths and several chunks of anchors."""
    rows = []
    for i in range(400):
        dim = rng.choice([8, 8, 8, 3, 1, 0, 40])
        v = [rng.choice([0.5, 0.25, -0.5, 1.0, rng.random(), rng.random() - 0.5]) for _ in range(dim)]
        rows.append((i * 5 - 300, v, rng.choice([0, 1, 1, 1, 2, -3])))
    rows += [(0, [0.5] * 8, 1), (0, [0.5] * 8, 1), (50, [0.1] * 8, 0), (None, [0.5] * 8, 1), (7, None, 1), (9, [0.5] * 8, None)]
    rows += [(1001, [float("nan")] * 8, 1), (1003, [float("inf")] + [0.0] * 7, 1), (1007, [None] + [0.5] * 7, 2)]
    rows += [(1100 + i, [0.5] * 8, i % 3) for i in range(60)] + [(2100, [0.5] * 8, 1), (2100, [0.75] * 8, -3)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows, schema).withColumns({"rank": F.lit("x"), "v": F.lit(1), "dim": F.lit("y")}).repartition(5)
    got = mined(hard_negatives.mine_hard_negatives(df, chunk_bytes=chunk_bytes))
    assert got == hard(rows) and got
    assert hard_negatives.mine_hard_negatives(df.limit(0)).count() == 0


def test_bounds_hold_and_large_numbers_are_exact(spark):
    r = np.random.default_rng(5)
    for scale, dim in ((300, 64), (5, 7), (2**28, 33), (1, 2)):
        v = r.integers(-scale, scale + 1, (60, dim))
        means, deviations = hard_negatives.summarize(v.astype("f8"))
        own = hard_negatives.Vectors(np.arange(60), np.zeros(60), v, means.astype("f4").astype("f8"), deviations.astype("f4").astype("f8"))
        exact = v.astype(object) @ v.T.astype(object)
        low = np.quantile(exact.astype("f8"), 0.9, axis=1)
        scores, alive = hard_negatives.bounded_scores(own, own, np.ones((60, 60), bool), low, np.full(60, np.inf))
        assert alive[exact.astype("f8") >= low[:, None]].all()
        assert (scores[alive] == exact[alive].astype("i8")).all()


def variants(docs, least_length=5, least_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(low(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    gaps = defaultdict(set)
    for w in n:
        gaps[w].add(w)
        for i in range(len(w)):
            gaps[w[:i] + w[i + 1 :]].add(w)

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = defaultdict(set)
    for w in n:
        close = set(gaps[w]).union(*(gaps[w[:i] + w[i + 1 :]] for i in range(len(w))))
        near[w] = {x for x in close if x != w and one_edit(w, x)}
    form = {}
    for w, c in n.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * c:
                form[w] = best
    out = set()
    for w, c in n.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, c, len(near[w]), n[form[w]] if w in form else None))
    return out


def spelled(df):
    return set(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_variants(case):
    docs, pairs = case
    want = variants(pairs)
    assert spelled(spelling.spelling_variants(docs)) == want


def test_variants_of_short_alphabets(spark, rng):
    """Runs of equal letters, long chains of forms, many near words, odd rows."""
    words = ["".join(rng.choice("abÀ") for _ in range(rng.choice([5, 6, 7]))) for _ in range(300)]
    docs = [(None, "aaaaa aaaaaa AAAAAA"), (1, None), (2, ""), (3, "x" * 3000 + " " + "x" * 3001)]
    docs += [(i, " ".join(w for w in words for _ in range(1 + (hash(w) + i) % 2))) for i in range(4)]
    chain = "k" * 5
    for step in range(7):
        docs.append((100 + step, " ".join([chain] * 2 ** (step + 2))))
        chain += "mnopqrs"[step]
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    got = spelled(spelling.spelling_variants(df, least_count=1))
    assert got == variants(docs, least_count=1)
    assert max(len(r[2]) - len(r[0]) for r in got) >= 3
    assert spelling.spelling_variants(df.limit(0)).count() == 0
