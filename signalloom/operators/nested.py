"""Redaction of nested data.

For a known schema the redaction is generated from the schema when the plan is
built: field names are judged once, not per row, and what runs is a projection
of built-in expressions.  JSON text of unknown shape goes through an Arrow UDF
with the same rules.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.redact import (
    MASKED_NAME,
    REDACTED,
    SECRET_NAME,
    mask_email,
    mask_text,
    masked_name,
    scrub_string,
    scrub_text,
    secret_name,
)
from signalloom.limits import MAX_ARRAY_ITEMS, MAX_NESTING

TOO_DEEP = "[MaxDepth]"
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def scrub_column(c: Column, t: T.DataType, depth: int = 0, counted: bool = False) -> Column:
    """R5 for one column of type ``t``.

    Secret fields become the marker string whatever their type was, and
    nested values below the depth limit become ``[MaxDepth]``.  Arrays keep
    their first 100 items where the rest can be told: arrays of strings end with
    ``[+N more]``, other arrays that are fields report N in a ``<field>_more``
    field beside them (``counted``, see ``scrub_struct``); arrays inside arrays
    or maps keep all items.  Map values that cannot hold the marker become
    null.  VARIANT is redacted as JSON of unknown shape.
    """
    if isinstance(t, _NESTED) and depth >= MAX_NESTING:
        return F.when(c.isNotNull(), F.lit(TOO_DEEP))
    if isinstance(t, T.StringType):
        return scrub_string(c)
    if isinstance(t, T.VariantType):
        return F.parse_json(scrub_json(F.to_json(c)))
    if isinstance(t, T.DecimalType) and t.scale == 0:
        return c.cast("string")
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*scrub_struct({f.name: c[f.name] for f in t}, t, depth)))
    if isinstance(t, T.ArrayType):
        told = counted or isinstance(t.elementType, T.StringType)
        kept = F.slice(c, 1, MAX_ARRAY_ITEMS) if told else c
        head = F.transform(kept, lambda x: scrub_column(x, t.elementType, depth + 1))
        if isinstance(t.elementType, T.StringType):
            more = F.concat(F.lit("[+"), (F.size(c) - MAX_ARRAY_ITEMS).cast("string"), F.lit(" more]"))
            return F.when(F.size(c) > MAX_ARRAY_ITEMS, F.concat(head, F.array(more))).otherwise(head)
        return head
    if isinstance(t, T.MapType):
        return F.transform_values(c, lambda k, v: _scrub_entry(k, v, t.valueType, depth))
    return c


def _scrub_entry(key: Column, value: Column, t: T.DataType, depth: int) -> Column:
    plain = scrub_column(value, t, depth + 1)
    if isinstance(t, T.StringType):
        return (
            F.when(key.rlike(SECRET_NAME), F.lit(REDACTED))
            .when(key.rlike(MASKED_NAME), mask_email(value))
            .otherwise(plain)
        )
    return F.when(~key.rlike(SECRET_NAME), plain)


def scrub_struct(fields: dict[str, Column], t: T.StructType, depth: int = 0) -> list[Column]:
    """The redacted fields of a struct, each under its name."""
    out = []
    is_error = set(t.names) == {"name", "message", "stack"}
    for f in t:
        c = fields[f.name]
        if secret_name(f.name):
            out.append(F.lit(REDACTED).alias(f.name))
        elif masked_name(f.name) and isinstance(f.dataType, T.StringType):
            out.append(mask_email(c).alias(f.name))
        elif is_error and f.name == "name":
            out.append(c.alias(f.name))
        else:
            out.append(scrub_column(c, f.dataType, depth + 1, counted=True).alias(f.name))
            if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, T.StringType):
                over = F.size(c) - MAX_ARRAY_ITEMS
                out.append(F.when(over > 0, over).alias(f"{f.name}_more"))
    return out


def scrub_nested(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """R5 on rows: the row is the outermost object.  Columns in ``keep`` (keys
    that later joins need) pass unchanged."""
    done = {}
    for name in keep:
        done[name] = F.col(f"`{name}`").alias(name)
    rest = T.StructType([f for f in df.schema if f.name not in done])
    scrubbed = scrub_struct({f.name: F.col(f"`{f.name}`") for f in rest}, rest)
    return df.select(*done.values(), *scrubbed)


def scrub_object(c: Column | str, t: T.DataType) -> Column:
    """R5 on one object column; null stays null."""
    return scrub_column(F.col(c) if isinstance(c, str) else c, t)


def _scrub_value(v, depth: int):
    if isinstance(v, str):
        return scrub_text(v)
    if isinstance(v, (list, dict)) and depth >= MAX_NESTING:
        return TOO_DEEP
    if isinstance(v, list):
        out = [_scrub_value(x, depth + 1) for x in v[:MAX_ARRAY_ITEMS]]
        return out + [f"[+{len(v) - MAX_ARRAY_ITEMS} more]"] if len(v) > MAX_ARRAY_ITEMS else out
    if isinstance(v, dict):
        return {k: _scrub_member(k, x, depth) for k, x in v.items()}
    return v


def _scrub_member(key: str, v, depth: int):
    if secret_name(key):
        return REDACTED
    if masked_name(key) and isinstance(v, str):
        return mask_text(v)
    return _scrub_value(v, depth + 1)


def _scrub_json_text(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return scrub_text(text)  # not JSON, or nested without end: still never let it through raw
    return json.dumps(_scrub_value(value, 0), separators=(",", ":"), ensure_ascii=False)


@F.pandas_udf(T.StringType())
def scrub_json(texts: pd.Series) -> pd.Series:
    """R5 on JSON text of unknown shape; text that is no JSON is redacted as a string."""
    return texts.map(_scrub_json_text)


def scrub_once_at_sink(df: DataFrame, json_columns: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """The one redaction pass right before rows are stored or sent."""
    scrubbed = scrub_nested(df, keep=(*keep, *json_columns))
    return scrubbed.withColumns({c: scrub_json(F.col(f"`{c}`")) for c in json_columns}).select(
        *[c for c in df.columns if c in scrubbed.columns],
        *[c for c in scrubbed.columns if c not in df.columns],
    )
