"""Operators 2, 6 and 7: near, partial and exact duplicates."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalloom.llm import minhash, radix_dedup, suffix_levels
from signalloom.llm.components import connected_components
from tests.llm import brute


@pytest.mark.parametrize("trie_bytes", [radix_dedup.TRIE_BYTES, 5000])
def test_exact(case, trie_bytes):
    docs, pairs = case
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[brute.lowered(text)].append(doc_id)
    rows = radix_dedup.exact_dedup(docs, trie_bytes=trie_bytes).collect()
    assert len(rows) == len(pairs)
    texts = dict(pairs)
    for r in rows:
        text = brute.lowered(texts[r["doc_id"]])
        same = groups[text]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(same), len(same), r["doc_id"] == max(same))
        assert r["text_sha256"] == brute.hashlib.sha256(text).hexdigest()


def test_exact_of_odd_ids(spark, empty_docs):
    assert radix_dedup.exact_dedup(empty_docs).count() == 0
    rows = [(None, "x"), (3, "X"), (3, "x"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, radix_dedup.exact_dedup(docs).select("group_size", "keep_id", "kept").collect()), key=str)
    assert got == sorted([(3, 3, False), (3, 3, True), (3, 3, True), (2, None, True), (2, None, True)], key=str)
    first = radix_dedup.exact_dedup(docs, keep_largest=False).where("keep_id = 3").count()
    assert first == 3


def test_digest_of_a_row_is_computed_once(documents, capsys):
    radix_dedup.drop_duplicates(documents).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_trie_splits_and_spills():
    trie = radix_dedup.RadixTrie(keep_largest=False)
    words = [b"romane", b"romanus", b"rom", b"", b"ruber", b"rom", b"romane", b"x"]
    for i, w in enumerate(words):
        trie.insert(w, (i, 1))
    got = dict(trie.drain())
    assert got == {b"romane": (0, 2), b"romanus": (1, 1), b"rom": (2, 2), b"": (3, 1), b"ruber": (4, 1), b"x": (7, 1)}
    assert trie.bytes == 0


def test_near(case):
    docs, pairs = case
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    want = brute.near_components(pairs)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def test_near_finds_members_their_hub_does_not_link(spark, rng):
    """Chains and families whose hub is far from some members."""
    words, rows, doc_id = [f"w{i}" for i in range(400)], [], 0
    for family in range(6):
        base = [f"f{family}"] + [rng.choice(words) for _ in range(180)]
        for _ in range(25):
            base = list(base)
            for _ in range(2 if family % 2 else 4):
                base[rng.randrange(len(base))] = f"e{rng.random()}"
            rows.append((doc_id := doc_id + 1, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == brute.near_components(rows)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for n in (1, 30, 200, 3000):
        for step in (1, 7, n):
            both = rng.integers(0, 1 << 63, n + step).astype(np.uint64)
            a, b = np.unique(both[:n]), np.unique(both[step:])
            differing = minhash.odd_sketch(a) ^ minhash.odd_sketch(b)
            apart = int(np.bitwise_count(differing.view(np.uint64)).sum())
            assert apart <= len(np.setxor1d(a, b))
            if step < 40:
                assert apart >= 0.8 * len(np.setxor1d(a, b))


def test_near_finds_links_of_a_family_without_its_base(spark, rng):
    """Copies edited so far that pairs lie on both sides of the threshold and no hub meets all."""
    words, rows = [f"w{i}" for i in range(300)], []
    base = [rng.choice(words) for _ in range(150)]
    for doc_id in range(160):
        copy = list(base)
        for _ in range(rng.randrange(1, 7)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(40)}"
        rows.append((doc_id, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == brute.near_components(rows)


def test_near_of_odd_ids(spark, empty_docs):
    assert minhash.near_duplicates(empty_docs).count() == 0
    rows = [(None, "a b c"), (5, "A b  c"), (5, "other words here"), (None, None), (7, None), (8, "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == sorted(
        [(None, 1, 5, False), (5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True), (7, 0, 7, True), (8, 0, 8, True)],
        key=str,
    )


def test_components_of_a_chain(spark):
    n = 300
    links = spark.createDataFrame([(f"{(i * 7) % n:04}", f"{(i * 7 + 7) % n:04}") for i in range(n - 1)], "a string, b string")
    rows = connected_components(links).collect()
    assert len(rows) == n and {r["label"] for r in rows} == {"0000"}


@pytest.mark.parametrize("n", [1, 5, 40, 100, 128, 129, 400])
def test_signatures_find_borderline_sets(n):
    rng = np.random.default_rng(n)
    missed = 0
    for _ in range(200):
        extra = max(1, n // 7)
        shared = max(6 * extra, n - extra)
        mine = rng.integers(0, 1 << 62, shared + 2 * extra).astype(np.uint64) * np.uint64(4)
        a, b = np.unique(mine[: shared + extra]), np.unique(np.concatenate([mine[:shared], mine[shared + extra :]]))
        assert minhash.similar(a, b)
        missed += not set(minhash.band_keys(a)) & set(minhash.band_keys(b))
    assert missed == 0


def test_repeats(case):
    docs, pairs = case
    want = brute.repeated_bytes(pairs)
    for r in suffix_levels.remove_repeats(docs).collect():
        assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]


@pytest.mark.parametrize("batch_rows,slice_bytes,piece_bytes", [(40, 3000, 1 << 23), (7, 1 << 22, 700)])
def test_repeats_over_many_batches(spark, rng, monkeypatch, batch_rows, slice_bytes, piece_bytes):
    """Small batches, slices and pieces, so that levels meet and merge."""
    alphabet = "ab \n"
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (99, 100, 101, 180, 400)]
    rows = []
    for i in range(120):
        parts = [rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choice("xyzuvw ") for _ in range(rng.randrange(90))) for _ in range(6)]
        rows.append((i, "".join(parts)))
    rows += [(900 + i, "ab" * (80 + i) + "".join(rng.choice(alphabet) for _ in range(150))) for i in range(5)] + [(990, "q" * 3000), (991, "é" * 70)]
    data = sorted(rows)
    areas = {d: [] for d, _ in data}
    monkeypatch.setattr(suffix_levels, "BATCH_ROWS", batch_rows)
    monkeypatch.setattr(suffix_levels, "PIECE_BYTES", piece_bytes)
    # the task functions in the order Spark runs them
    pieces, held, size = [], [], 0
    for d, t in data:
        held.append((d, 0, t.encode()))
        size += len(t)
        if size > slice_bytes:
            pieces.append(suffix_levels._scan_slice(held))
            held, size = [], 0
    pieces.append(suffix_levels._scan_slice(held))
    rows_ = {k: np.concatenate([p[k] for p in pieces]) for k in suffix_levels._NAMES}
    order = np.lexsort([rows_[k] for k in reversed(suffix_levels._NAMES)])
    table = suffix_levels.pa.Table.from_batches([suffix_levels._batch({k: v[order] for k, v in rows_.items()})])
    met = suffix_levels.pa.Table.from_batches(list(suffix_levels._met(table.to_batches(max_chunksize=37))))
    by_doc = {}
    for r in met.to_pylist():
        by_doc.setdefault(r["d"], []).append(r)
    pack = suffix_levels.zstandard.ZstdCompressor().compress
    texts = dict(data)
    batch = suffix_levels.pa.RecordBatch.from_pylist(
        [
            {"d": d, "tie": 0, "packed": pack(texts[d].encode()), "hashes": [r["hash"] for r in rs], "places": [r["at"] for r in rs]}
            for d, rs in by_doc.items()
        ]
    )
    cut = suffix_levels.pa.Table.from_batches(list(suffix_levels._cut([batch]))).sort_by([("d", "ascending"), ("at", "ascending")])
    for out in suffix_levels._match(cut.to_batches(max_chunksize=50)):
        for r in out.to_pylist():
            areas[r["d"]].append(r["at"])
    want = brute.repeated_bytes(rows)
    for d, _ in data:
        spans = suffix_levels.merge_areas(areas[d])
        assert (sum(e - b for b, e in spans), len(spans)) == want[d][1:3], d


@pytest.mark.parametrize("doc_id", [5, None])
def test_repeats_of_texts_with_one_id_and_like_hashes(spark, doc_id):
    """Two texts under one doc_id, or none, whose 32-bit hashes agree, are two documents."""
    text = F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(f"/{i}"))) for i in range(5)])
    hashed = spark.range(400_000).select("id", F.hash(text).alias("h"), text.alias("text"))
    pair = hashed.groupBy("h").agg(F.min_by("text", "id").alias("a"), F.max_by("text", "id").alias("b")).where("a <> b").first()
    rows = [(doc_id, pair["a"]), (doc_id, pair["b"]), (9, "x" + pair["b"]), (10, pair["a"] + "y")]
    got = suffix_levels.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 5, r["n_removed"]) for r in got) == [(5, 0), (5, 0), (9, 160), (10, 160)]


@pytest.mark.parametrize("hot_rows", [2, 40])
def test_repeats_through_hot_anchors(spark, case, rng, hot_rows):
    """A passage inside different texts, with every anchor or only its edges hot."""
    docs, pairs = case
    passage = "".join(rng.choice("abcdefgh ") for _ in range(500))
    noise = lambda: "".join(rng.choice("tuvwxyz ") for _ in range(rng.randrange(20, 160)))
    more = [(100_000 + i, noise() + passage[i % 3 :] + noise()) for i in range(150)] + [(100_007, "x" + passage + "y")]
    more = list(dict(more).items())
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string").repartition(7))
    frame = frame.union(spark.createDataFrame(more[:5], "doc_id long, text string"))  # rows equal in all count once
    want = brute.repeated_bytes(pairs + more)
    got = suffix_levels.remove_repeats(frame, hot_rows=hot_rows).collect()
    assert len(got) == len(pairs) + len(more) + 5
    for r in got:
        assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]


def test_hot_anchors_are_not_held_together(rng, monkeypatch):
    """No batch or level has more rows of one anchor hash than the bound."""
    monkeypatch.setattr(suffix_levels, "BATCH_ROWS", 50)
    largest, add = [0], suffix_levels.Family.add

    def watched(family, rows):
        found = add(family, rows)
        kept = np.concatenate([rows.hash[:0], *(level.rows.hash for level in family.levels)])
        largest.append(max((np.unique(h, return_counts=True)[1].max() for h in (rows.hash, kept) if len(h)), default=0))
        return found

    passage = "".join(rng.choice("abcdefgh ") for _ in range(300)).encode()
    noise = lambda: "".join(rng.choice("tuvwxyz ") for _ in range(120)).encode()
    texts = [noise() + passage + noise() for _ in range(400)]
    parts = [suffix_levels._scan_slice([(d, 0, t)]) for d, t in enumerate(texts)]
    rows = {k: np.concatenate([p[k] for p in parts]) for k in suffix_levels._NAMES}
    order = np.lexsort([rows[k] for k in reversed(suffix_levels._NAMES)])
    bound = {"hot_rows": 100} if hasattr(suffix_levels, "HOT_ROWS") else {}
    table = suffix_levels.pa.Table.from_batches([suffix_levels._batch({k: v[order] for k, v in rows.items()})])
    by_doc = {}
    for out in suffix_levels._met(table.to_batches(max_chunksize=37), **bound):
        for r in out.to_pylist():
            by_doc.setdefault(r["d"], []).append(r)
    pack = suffix_levels.zstandard.ZstdCompressor().compress
    batch = suffix_levels.pa.RecordBatch.from_pylist(
        [
            {"d": d, "tie": 0, "packed": pack(texts[d]), "hashes": [r["hash"] for r in rs], "places": [r["at"] for r in rs]}
            for d, rs in by_doc.items()
        ]
    )
    cut = [r for b in suffix_levels._cut([batch]) for r in b.to_pylist()]
    cut.sort(key=lambda r: (r["hash"], r["around"], r["d"], r["at"]) if r["at"] >= 1 << 62 else (r["d"], b"", 0, r["at"]))
    monkeypatch.setattr(suffix_levels.Family, "add", watched)
    areas = {d: [] for d in range(len(texts))}
    for out in suffix_levels._match(suffix_levels.pa.Table.from_pylist(cut).to_batches(max_chunksize=50)):
        for r in out.to_pylist():
            areas[r["d"]].append(r["at"])
    want = brute.repeated_bytes([(d, t.decode()) for d, t in enumerate(texts)])
    for d in areas:
        spans = suffix_levels.merge_areas(areas[d])
        assert (sum(e - b for b, e in spans), len(spans)) == want[d][1:3], d
    assert max(largest) <= 100


def test_repeats_of_odd_ids(spark, empty_docs):
    assert suffix_levels.remove_repeats(empty_docs).count() == 0
    long = "".join(f"{i} " for i in range(60))
    rows = [(4, long), (4, long), (None, "x" + long), (9, "short"), (9, None), (10, "y" + long + "z")]
    got = suffix_levels.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got), key=str) == sorted(
        [(4, len(long), len(long))] * 2 + [(None, len(long) + 1, 0), (9, 5, 0), (9, 0, 0), (10, len(long) + 2, len(long))], key=str
    )


def test_common_shingles_are_counted(spark, rng):
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(40)) for _ in range(30)] + ["only of its own kind here now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = minhash.shingled(docs).select("doc_id", "tie", "node", F.col("n_shingles").alias("n")).cache()
    packed = minhash._packed_texts(docs, table.select("node", "doc_id", "tie"))
    got = {r["node"]: r["common"] for r in minhash._common_shingles(table.select("node", "n"), packed).collect()}
    sets = {r["node"]: brute.shingles(texts[r["doc_id"]]) for r in table.collect()}
    for node, mine in sets.items():
        others = set().union(*(s for k, s in sets.items() if k != node))
        assert got[node] == len(mine & others)


def test_exact_dedup_has_sql():
    import __spark_entry__ as driver

    assert "op7_exact_dedup" in driver.oracle_sql()


def test_near_tells_words_apart_that_a_power_of_two_confuses(spark):
    """The two halves of a doubling sequence and its complement, 1,024 letters each."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, "x " * 3), (4, None)], "doc_id long, text string")
    assert [tuple(r) for r in minhash.near_duplicates(docs).select("doc_id", "component_id").orderBy("doc_id").collect()] == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_words_across_pieces_have_their_hash(rng, monkeypatch):
    texts = ["", " ", "a" * 500, *[" ".join("abc"[: rng.randint(1, 3)] * rng.randint(1, 30) for _ in range(rng.randint(0, 40))) for _ in range(30)]]
    texts = [t.encode() for t in texts]
    whole = minhash._Hasher().words(texts)
    monkeypatch.setattr(minhash, "_PIECE", 64)
    for a, b, t in zip(whole, minhash._Hasher().words(texts), texts, strict=True):
        assert len(a) == len(t.split()) and (a == b).all()
    hashes = {}
    for t, found in zip(texts, whole):
        for w, h in zip(t.split(), found):
            assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_drop_near_leaves_one_row_of_each(spark):
    """Near copies under one doc_id, without doc_id, rows that are equal; texts without words stay."""
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(9, "a b c", 1), (9, "A b  c", 2), (7, long, 3), (None, long + " more", 4), (None, "x y", 5), (None, "X y", 6),
            (5, "q r s", 7), (5, "q r s", 8), (None, "", 9), (None, "", 10), (3, None, 11), (3, None, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int").repartition(4)
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    got = [r["node"] for r in left.collect()]
    assert len(got) == len(set(got)) == 8
    assert {3, 9, 10, 11, 12} <= set(got) and len({1, 2} & set(got)) == len({5, 6} & set(got)) == len({7, 8} & set(got)) == 1
    assert 4 not in got
