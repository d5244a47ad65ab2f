"""Small string, size and default helpers (U*, V1-V3, V5, V6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.redact import bind
from signalloom.limits import (
    MAX_BODY_BYTES,
    MAX_ERROR_TEXT_CHARS,
    MAX_MESSAGE_BYTES,
    MAX_METADATA_BYTES,
    MAX_TAG_CHARS,
    MAX_TAGS,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str, default: Column | str) -> Column:
    """``c`` unless it is null or the empty string."""
    c = _col(c)
    default = F.lit(default) if isinstance(default, str) else default
    return F.when(c.isNotNull() & (c != ""), c).otherwise(default)


def truncate_text(c: Column | str, limit: int = MAX_ERROR_TEXT_CHARS) -> Column:
    """Cut to ``limit`` characters and state the total length."""

    def cut(text: Column) -> Column:
        n = F.char_length(text)
        return F.when(
            n > limit,
            F.concat(
                F.substring(text, 1, limit),
                F.lit("... [truncated, total "),
                n.cast("string"),
                F.lit(" chars]"),
            ),
        ).otherwise(text)

    return bind(_col(c), cut)


def parse_json(c: Column | str, schema: T.StructType | str, fallback: Column | None = None) -> Column:
    """Parse, or the fallback where the text is not a value of ``schema``."""
    parsed = F.from_json(_col(c), schema)
    return parsed if fallback is None else F.coalesce(parsed, fallback)


def json_text(c: Column | str) -> Column:
    """JSON text of a struct, map or array; absent fields are left out."""
    return F.to_json(_col(c))


def event_id() -> Column:
    """U4: random id."""
    return F.uuid()


def iso_time(c: Column | str) -> Column:
    """U4: ISO-8601 text with milliseconds, in the (UTC) session time zone."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def stack_or_summary(stack: Column | str, name: Column | str, message: Column | str) -> Column:
    """The stack, or ``name: message`` where there is none."""
    return filled(stack, F.concat(_col(name), F.lit(": "), _col(message)))


def deep_merge(base: Column, over: Column, base_type: T.DataType, over_type: T.DataType) -> Column:
    """``over`` wins field by field; structs merge, everything else is replaced.

    A null in ``over`` means "not given".  The result holds every field of
    both types; maps merge by key.
    """
    if isinstance(base_type, T.StructType) and isinstance(over_type, T.StructType):
        fields = []
        for f in base_type.fields:
            if f.name in over_type.names:
                merged = deep_merge(base[f.name], over[f.name], f.dataType, over_type[f.name].dataType)
            else:
                merged = base[f.name]
            fields.append(merged.alias(f.name))
        fields += [over[f.name].alias(f.name) for f in over_type.fields if f.name not in base_type.names]
        both = F.struct(*fields)
        return F.when(over.isNull(), F.when(base.isNotNull(), both)).otherwise(both)
    if isinstance(base_type, T.MapType) and isinstance(over_type, T.MapType):
        return F.when(over.isNull(), base).when(base.isNull(), over).otherwise(merge_maps(base, over))
    return F.coalesce(over, base)


def merge_maps(base: Column, over: Column) -> Column:
    """Union of two maps in which ``over`` wins, whatever the dedup policy of the session.

    Keys keep the place where they first appear, as in a spread of objects.
    """
    kept = F.transform_values(base, lambda k, v: F.coalesce(F.element_at(over, k), v))
    new = F.map_filter(over, lambda k, _v: ~F.map_contains_key(base, k))
    return F.map_concat(kept, new)


def clamp_message(c: Column | str) -> Column:
    """V1: over 2 KiB of UTF-8, keep the first 2048 characters and a marker."""
    c = _col(c)
    return F.when(
        F.octet_length(c) > MAX_MESSAGE_BYTES,
        F.concat(F.substring(c, 1, MAX_MESSAGE_BYTES), F.lit("... [truncated]")),
    ).otherwise(c)


def json_size(c: Column | str, is_json_text: bool = False) -> Column:
    """V6: UTF-8 bytes of the JSON form (of a nested column, or of JSON text)."""
    c = _col(c)
    return F.octet_length(c if is_json_text else F.to_json(c))


METADATA_DROPPED = '{"__dropped":"metadata exceeded size limit"}'


def clamp_metadata(c: Column | str, is_json_text: bool = True) -> Column:
    """V2: metadata over 8 KiB of JSON becomes a one-key marker object."""
    c = _col(c)
    text = c if is_json_text else F.to_json(c)
    return F.when(F.octet_length(text) > MAX_METADATA_BYTES, F.lit(METADATA_DROPPED)).otherwise(text)


def clamp_tags(c: Column | str) -> Column:
    """V3: at most 20 tags, keys and values of at most 64 characters.

    When two keys become equal by the cut, the later value is kept at the
    place of the earlier key.
    """
    c = _col(c)
    long = F.exists(
        F.map_entries(c),
        lambda e: (F.char_length(e["key"]) > MAX_TAG_CHARS) | (F.char_length(e["value"]) > MAX_TAG_CHARS),
    )
    cut = F.transform(
        F.slice(F.map_entries(c), 1, MAX_TAGS),
        lambda e: F.struct(
            F.substring(e["key"], 1, MAX_TAG_CHARS).alias("key"),
            F.substring(e["value"], 1, MAX_TAG_CHARS).alias("value"),
        ),
    )

    def rebuilt(entries: Column) -> Column:
        names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        last = F.transform(
            names,
            lambda k: F.struct(
                k.alias("key"),
                F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"),
            ),
        )
        return F.map_from_entries(F.when(F.size(names) < F.size(entries), last).otherwise(entries))

    # nearly all maps are small already and stay as they are
    return F.when((F.size(c) <= MAX_TAGS) & ~long, c).when(c.isNotNull(), F.transform(F.array(cut), rebuilt)[0])


def within_size(body: Column | str, mode: str = "fetch") -> Column:
    """V5 predicate: the serialised body fits the transport."""
    return F.octet_length(_col(body)) <= MAX_BODY_BYTES[mode]


def size_gate(df: DataFrame, body: Column | str = "body", mode: str = "fetch") -> tuple[DataFrame, DataFrame]:
    """V5: (rows that fit, rows that do not)."""
    fits = F.coalesce(within_size(body, mode), F.lit(False))
    return df.filter(fits), df.filter(~fits)
