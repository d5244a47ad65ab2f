"""Operator 13: spelling variants by rotations of terminator-marked words.

Every rotation of ``word$`` is a key for the words that have it as a whole, and
every rotation without its last letter is a key for the words that differ in
that letter.  So the words under one key are a text with a gap, at most one
with the gap left empty and the others with one letter in it: all of them are
one insertion, deletion or replacement apart, and all pairs that are one edit
apart meet.  A key holds one word per letter of the alphabet at most, whatever
the size of the vocabulary.

Neighbours are counted, not listed: in a group of k words each has k - 1.  Two
words meet twice only if a letter of a run was inserted ("ab", "aab"); that
counts for the first place of the run alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import whole_text
from signalloom.sources.scratch import materialize

# Letters of a word, the share of shortened runs, and what a word needs to count.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEN_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_END = "$"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other characters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def count_words(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, shorten_every: int | None = SHORTEN_EVERY
) -> DataFrame:
    """(word, n): runs of letters of all texts, counted.

    Of each ``shorten_every``-th run of a document, by crc32 of ``id:run``, one
    letter is taken out.  Null texts have no words; a null ``doc_id`` is written
    as nothing.  Repeated rows count each time.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"),
        F.explode(F.split(lower_ascii(whole_text()), f"[^{LETTERS}]+")).alias("__run"),
    ).where("__run <> ''")
    word = F.col("__run")
    if shorten_every:
        code = F.crc32(F.concat(F.col("__id"), F.lit(":"), word))
        at = F.pmod(code, F.length(word)).cast("int")
        shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
        word = F.when(F.pmod(code, F.lit(shorten_every)) == 0, shorter).otherwise(word)
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(key, n, letter, first) of every rotation of ``word$``, whole and without its last letter.

    A whole rotation has a null ``letter``.  ``first`` tells that the letter
    before it in the word is another one.
    """
    marked = F.concat(F.col("word"), F.lit(_END))
    turned = words.select("word", "n", marked.alias("__m"), F.explode(F.sequence(F.lit(0), F.length("word"))).alias("__i"))
    rotation = F.concat(F.substring(F.col("__m"), F.col("__i") + 1, F.length("__m")), F.substring(F.col("__m"), F.lit(1), F.col("__i")))
    letter = F.substring(F.col("word"), F.col("__i"), F.lit(1))
    before = F.substring(F.col("word"), F.col("__i") - 1, F.lit(1))
    turned = turned.select(
        "n",
        F.col("__i"),
        rotation.alias("__r"),
        F.when(F.col("__i") > 0, letter).alias("__letter"),
        ((F.col("__i") == 1) | (letter != before)).alias("__first"),
    )
    nothing = F.lit(None).cast("string")
    whole = F.struct(F.col("__r").alias("key"), nothing.alias("letter"), F.lit(False).alias("first"))
    gap = F.struct(
        F.substring(F.col("__r"), F.lit(1), F.length("__r") - 1).alias("key"),
        F.col("__letter").alias("letter"),
        F.col("__first").alias("first"),
    )
    keys = F.when(F.col("__i") > 0, F.array(whole, gap)).otherwise(F.array(whole))
    return turned.select("n", F.explode(keys).alias("__k")).select("__k.key", "n", "__k.letter", "__k.first")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have a near word.

    ``words`` must be distinct.  ``best`` is the near word of largest n, of
    several the smallest.
    """
    member = F.struct((-F.col("n")).alias("minus_n"), F.col("letter"), F.col("first"))
    groups = rotations(words).groupBy("key").agg(F.collect_list(member).alias("__g")).where(F.size("__g") > 1)
    head, tail = F.substring_index("key", _END, -1), F.substring_index("key", _END, 1)
    # largest n first, of equal n the smallest word
    ranked = F.sort_array(
        F.transform(
            "__g",
            lambda m: F.struct(
                m["minus_n"].alias("minus_n"),
                F.concat(F.col("__head"), F.coalesce(m["letter"], F.lit("")), F.col("__tail")).alias("word"),
                m["letter"].isNotNull().alias("edited"),
                m["first"].alias("first"),
            ),
        )
    )
    spelled = groups.select("__g", head.alias("__head"), tail.alias("__tail")).select(ranked.alias("__g"))
    met = spelled.select(
        F.slice("__g", 1, 2).alias("__top"),
        F.size(F.filter("__g", lambda m: m["edited"])).alias("__edited"),
        F.size(F.filter("__g", lambda m: m["first"])).alias("__first"),
        F.exists("__g", lambda m: ~m["edited"]).alias("__whole"),
        F.explode("__g").alias("__m"),
    )
    beside = (F.col("__m.first") & F.col("__whole")).cast("int")
    near = F.when(F.col("__m.edited"), F.col("__edited") - 1 + beside).otherwise(F.col("__first"))
    top = F.when(F.col("__top")[0]["word"] == F.col("__m.word"), F.col("__top")[1]).otherwise(F.col("__top")[0])
    pairs = met.select(F.col("__m.word").alias("word"), near.alias("near"), top.alias("top"))
    return (
        pairs.groupBy("word")
        .agg(F.sum("near").cast("long").alias("n_near"), F.min(F.struct("top.minus_n", "top.word")).alias("__b"))
        .select("word", "n_near", (-F.col("__b.minus_n")).alias("best_n"), F.col("__b.word").alias("best"))
    )


def follow(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) that hold no cycle; the steps double each round.

    Every round is a written table, so that none depends on those before.
    """
    reached = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        stepped = reached.join(further, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")
        )
        stepped = materialize(stepped, "roots")
        if stepped.where("__moved").isEmpty():
            return stepped.select("word", "root")
        reached = stepped.drop("__moved")


def spelling_variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = 2, shorten_every: int | None = SHORTEN_EVERY
) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of the texts.

    A word's form is its near word of largest n, if that is ``ratio`` (2 or
    more) times its own; its root is the last form of the chain, itself without
    one.  No texts, or none with words: no rows.  Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("a chain of forms ends only if counts grow")
    words = materialize(count_words(docs, least_length, least_count, shorten_every), "words")
    joined = words.join(neighbours(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(
        joined.select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
