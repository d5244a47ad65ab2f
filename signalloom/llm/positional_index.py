"""Operator 11: benchmark passages in training documents, by a positional inverted index.

``build_index`` writes one posting (term, row, position) per word.  Each task
writes a segment of the index, ordered by term, so that nothing is shuffled and
a term's postings lie together.  A document is one more row at position 0, with
its id and its number of words.

A phrase search starts from the rarest words of every window of consecutive
words.  The postings of the two rarest, each moved back by its place in the
item, meet where the window can stand; only there the other words are asked
for, and runs of words that all stand where they should are hits.  Words that
many windows of an item share are looked up once for all of them.

All of it is built-in functions of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import marked, whole_text
from signalloom.operators.sizing import fits_broadcast, maybe_broadcast
from signalloom.sources.scratch import materialize, scratch_path

# What stands between words, and the words of a window.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

#: Positions of a document that are looked up together.
_PART = 256

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words of a text; the first and last may be empty where it begins or ends between words."""
    return F.split(F.translate(text, _UPPER, _UPPER.lower()), BETWEEN_WORDS)


def _n_words(words: Column) -> Column:
    n = F.size(words)
    blanks = (F.get(words, F.lit(0)) == "").cast("int") + (F.get(words, n - 1) == "").cast("int")
    return F.greatest(n - blanks, F.lit(0)).cast("long")


def build_index(docs: DataFrame, path: str) -> DataFrame:
    """Writes the index of ``docs`` (doc_id, text) to ``path`` and returns it.

    Every row of ``docs`` is a document of its own, numbered by ``row_no``,
    whatever its id.  Null and empty texts have a document row and no postings.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", words_of(whole_text()).alias("__w"))
    headed = rows.select("row_no", "doc_id", _n_words(F.col("__w")).alias("__n"), F.concat(F.array(F.lit(None).cast("string")), "__w").alias("__w"))
    posted = headed.select("row_no", "doc_id", "__n", F.posexplode("__w").alias("pos", "term")).where("pos = 0 or term <> ''")
    head = F.col("pos") == 0
    index = posted.select(
        "term", "row_no", "pos", F.when(head, F.col("doc_id")).alias("doc_id"), F.when(head, F.col("__n")).alias("n_words")
    )
    # a number sorts faster than a text; equal terms are neighbours all the same
    index.sortWithinPartitions(F.xxhash64("term")).write.parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def indexed_documents(index: DataFrame) -> DataFrame:
    """(row_no, doc_id, n_words) of every document."""
    return index.where(F.col("n_words").isNotNull()).select("row_no", "doc_id", "n_words")


def postings(index: DataFrame) -> DataFrame:
    """(term, row_no, pos) of every word."""
    return index.where(F.col("term").isNotNull()).select("term", "row_no", "pos")


def item_texts(items: DataFrame) -> DataFrame:
    """(item, text, words) of every distinct text of ``items``: a written table, as ``item`` numbers the texts."""
    texts = items.where(F.col("text").isNotNull()).select("text").distinct()
    words = F.filter(words_of(F.col("text")), lambda w: w != "")
    return materialize(texts.select(F.monotonically_increasing_id().alias("item"), "text", words.alias("words")), "items")


def item_terms(texts: DataFrame) -> DataFrame:
    """(item, n, q, term): the words of ``item_texts`` at their places."""
    return texts.select("item", F.size("words").alias("n"), F.posexplode("words").alias("q", "term"))


def join_terms(posted: DataFrame, side: DataFrame, salts: int = 16) -> DataFrame:
    """Postings joined with a table of terms; if that is too large to be broadcast, frequent terms are dealt by row."""
    if fits_broadcast(side):
        return posted.join(F.broadcast(side), "term")
    dealt = posted.withColumn("__salt", F.pmod(F.xxhash64("row_no"), F.lit(salts)).cast("int"))
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, ["term", "__salt"]).drop("__salt")


def term_counts(index: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, f): postings of each term, of ``vocabulary`` at least."""
    terms = postings(index).select("term")
    if fits_broadcast(vocabulary):
        terms = terms.join(F.broadcast(vocabulary), "term", "left_semi")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("f"))


def rarest_terms(terms: DataFrame, index: DataFrame, window: int, rarest: int = 2) -> DataFrame:
    """(item, q, term) of the ``rarest`` rarest words of each window that can occur, each once.

    Rare are words with few postings.  A window with a word that has none occurs nowhere.
    """
    counts = materialize(term_counts(index, terms.select("term").distinct()), "term-counts")
    counted = terms.join(maybe_broadcast(counts), "term", "left")
    found = F.struct(F.coalesce("f", F.lit(0)).alias("f"), "q", "term")
    whole = counted.groupBy("item", "n").agg(F.sort_array(F.collect_list(F.struct("q", found.alias("w")))).alias("__w"))
    k = F.least(F.col("n"), F.lit(window))
    starts = whole.select(F.col("__w.w").alias("__w"), "item", k.alias("__k"), F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("s"))
    windows = starts.select("item", F.sort_array(F.slice("__w", F.col("s") + 1, F.col("__k"))).alias("__w"))
    usable = windows.where(F.col("__w")[0]["f"] > 0).select("item", F.explode(F.slice("__w", 1, rarest)).alias("__w"))
    return usable.select("item", "__w.q", "__w.term").distinct()


def near_candidates(posted: DataFrame, probes: DataFrame) -> DataFrame:
    """Postings in the parts of documents that ``probes`` (row_no, pos) ask for, and some more."""
    part = F.xxhash64("row_no", F.floor(F.col("pos") / _PART))
    return marked(posted, part, probes, part)


def phrase_hits(index: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row_no, pos, item): document words inside an occurrence of a window of an item.

    ``terms`` are ``item_terms``.  A window is ``window`` consecutive words of an
    item, or all of a shorter item.
    """
    posted = postings(index)
    lists = materialize(rarest_terms(terms, index, window), "rarest")
    # offset-adjusted: equal shifts of one item in one document are one alignment
    adjusted = join_terms(posted, lists).select("item", "row_no", (F.col("pos") - F.col("q")).alias("shift"), "q")
    aligned = adjusted.groupBy("item", "row_no", "shift").agg(F.array_sort(F.collect_set("q")).alias("__q"))
    sizes = terms.select("item", "n").distinct()
    # the two rarest words of a window lie within it; of a window of one word there is one
    steps = F.sequence(F.lit(1), F.size("__q") - 1)
    close = (F.size("__q") > 1) & F.exists(F.when(F.size("__q") > 1, steps), lambda i: F.get("__q", i) - F.get("__q", i - 1) < window)
    alive = aligned.join(maybe_broadcast(sizes), "item").where((F.least(F.col("n"), F.lit(window)) == 1) | close)
    alignments = materialize(alive.select("item", "row_no", "shift", "n", F.array_min("__q").alias("low"), F.array_max("__q").alias("high")), "alignments")
    # all words of the windows around them
    places = F.sequence(F.greatest(F.col("low") - window + 1, F.lit(0)), F.least(F.col("high") + window - 1, F.col("n") - 1))
    asked = alignments.select("item", "row_no", "shift", "n", F.explode(places).alias("q"))
    asked = asked.join(maybe_broadcast(terms.select("item", "q", "term")), ["item", "q"])
    asked = asked.select("item", "row_no", "shift", "n", "q", "term", (F.col("shift") + F.col("q")).alias("pos")).where("pos > 0")
    asked = materialize(asked, "asked")
    vocabulary = terms.select("term").distinct()
    if fits_broadcast(vocabulary):
        posted = posted.join(F.broadcast(vocabulary), "term", "left_semi")
    wanted = near_candidates(posted, asked)
    matched = asked.join(wanted, ["row_no", "pos", "term"]).select("item", "row_no", "shift", "n", "q")
    # runs of words in place; a run of a window's length is an occurrence, or several
    alignment = Window.partitionBy("row_no", "item", "shift")
    run = matched.withColumn("__run", F.col("q") - F.row_number().over(alignment.orderBy("q")))
    long = run.withColumn("__len", F.count(F.lit(1)).over(Window.partitionBy("row_no", "item", "shift", "__run")))
    hits = long.where(F.col("__len") >= F.least(F.col("n"), F.lit(window)))
    return hits.select("row_no", (F.col("shift") + F.col("q")).alias("pos"), "item")


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are
    not read.  Null texts have no words and items without words no windows.
    Repeated documents are reported each; items with one id, or with none, are
    one item, the missing id being written as nothing.  ``path`` is where the
    index is left; without it, it is a scratch table.
    """
    index = build_index(docs, path or scratch_path(docs.sparkSession, "postings"))
    texts = item_texts(items)
    terms = item_terms(texts)
    hits = materialize(phrase_hits(index, terms, window), "hits")
    words = hits.select("row_no", "pos").distinct().groupBy("row_no").agg(F.count(F.lit(1)).alias("n_hit"))
    named = items.join(texts.select("item", "text"), "text").select("item", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("__id"))
    ids = hits.select("row_no", "item").distinct().join(maybe_broadcast(named.distinct()), "item")
    ids = ids.groupBy("row_no").agg(F.array_sort(F.collect_set("__id")).alias("__ids"))
    found = words.join(ids, "row_no")
    none = F.array().cast("array<string>")
    return (
        indexed_documents(index)
        .join(found, "row_no", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("__ids"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("__ids", none), ","), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def proximity_matches(index: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """(item, row_no, pos): where a span of ``within`` words begins that holds all words of a query, in any order.

    ``queries`` are ``item_terms``.  ``pos`` is the place of a query word, and
    the query's other words stand in the ``within - 1`` places after it.
    Documents are narrowed down by the query's rarest word first.
    """
    wanted = queries.select("item", "term").distinct()
    sizes = wanted.groupBy("item").agg(F.count(F.lit(1)).alias("m"))
    posted = postings(index)
    counts = term_counts(index, wanted.select("term").distinct())
    ranked = wanted.join(counts, "term", "left").groupBy("item").agg(F.min(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "term")).alias("__r"))
    rarest = ranked.where("__r.f > 0").select("item", "__r.term")
    around = join_terms(posted, rarest).select("item", "row_no", F.explode(F.array(*[F.floor(F.col("pos") / within) + d for d in (-1, 0, 1)])).alias("__b"))
    around = materialize(around.distinct(), "around")
    near = join_terms(posted, wanted).withColumn("__b", F.floor(F.col("pos") / within))
    near = near.join(around, ["item", "row_no", "__b"], "left_semi")
    span = Window.partitionBy("item", "row_no").orderBy("pos").rangeBetween(0, within - 1)
    held = near.withColumn("__held", F.size(F.collect_set("term").over(span)))
    return held.join(maybe_broadcast(sizes), "item").where(F.col("__held") == F.col("m")).select("item", "row_no", "pos")
