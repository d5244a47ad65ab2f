"""Reading and writing events and their envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.limits import REQUEST_BATCH
from signalloom.schemas import EVENT

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENT) -> DataFrame:
    """One JSON event per line; lines that are no event keep their text in ``_corrupt_record``."""
    reader = spark.read.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def stream_events(
    spark: SparkSession, path: str, schema: T.StructType = EVENT, max_files: int | None = None
) -> DataFrame:
    """S1 for files that keep arriving."""
    reader = spark.readStream.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def parse_events(raw: Column | str, schema: T.StructType = EVENT) -> Column:
    """An event from text, for message queues and text tables."""
    return F.from_json(raw, _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})


def explode_batches(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelopes ``{"events": [...]}`` and bare events as one row per event.

    Adds ``pos`` and ``event_json``; ``value`` itself is dropped.
    """
    events = F.from_json(value, "events array<string>")["events"]
    listed = F.coalesce(events, F.array(F.col(value)))
    kept = [c for c in df.columns if c != value]
    return df.select(*kept, F.posexplode(listed).alias("pos", "event_json"))


def write_batches(
    df: DataFrame,
    batch: str = "batch_id",
    pos: str = "pos",
    body: str = "body",
    size: int = REQUEST_BATCH,
) -> DataFrame:
    """S3: one serialised request per batch: ``batch``, ``chunk``, ``n_events``, ``body``.

    No request carries more than ``size`` events: a longer batch becomes
    several chunks, so the lists that are collected stay short.  ``pos`` counts
    from 0 without repeats, as ``assign_batches`` gives it.  A row without a body
    is not sent and not counted.
    """
    item = F.struct(F.col(pos).alias("p"), F.col(body).alias("b"))
    grouped = df.where(F.col(body).isNotNull()).groupBy(batch, F.floor(F.col(pos) / size).alias("chunk")).agg(
        F.array_sort(F.collect_list(item)).alias("__items")
    )
    texts = F.transform("__items", lambda i: i["b"])
    envelope = F.concat(F.lit('{"events":['), F.array_join(texts, ","), F.lit("]}"))
    return grouped.select(
        batch,
        "chunk",
        F.size("__items").alias("n_events"),
        F.when(F.size("__items") == 1, texts[0]).otherwise(envelope).alias("body"),
    )
