"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns documents with
the same columns; the last returns the pieces of packed sequences.  Tables
between stages are Parquet in the folder that ``spark.checkpoint.dir`` names, so
a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.llm import minhash, packing, pii, radix_dedup, rules
from signalloom.llm.common import read_table
from signalloom.sources.scratch import materialize


_REST = "other_columns"


def _with_rest(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` over doc_id, text and all other columns in one, so that no name of theirs meets one of its own."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = docs.select("doc_id", "text", F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`").alias(f"{i + 1}") for i, c in enumerate(rest)]).alias(_REST))
    back = {c: F.col(_REST)[f"{i + 1}"].alias(c) for i, c in enumerate(rest)}
    return stage(held).select(*[back.get(c, F.col(f"`{c}`")) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, learned from ``labels``, accept."""
    model = rules.train(docs, read_table(spark, sf_dir, "labels"))
    return _with_rest(docs, lambda d: rules.score_quality(d, model).where("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return _with_rest(docs, radix_dedup.drop_duplicates)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return _with_rest(docs, minhash.drop_near_duplicates)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars is counted anew."""
    masked = _with_rest(docs, pii.mask_personal)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of up to 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("personal data", mask_private),
    ("packing", pack),
]

#: The classifier, shingle sets and tokens are not expressible in SQL; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
