"""Ordered computations per key that do not put a hot key into one task.

A plain window over (key order by time) sorts every row of a key in one task,
which is fine for most keys and unusable for one that holds a third of the
data.  Keys with more than ``hot_rows`` rows are therefore cut into slices of
the order: bounds are quantiles of a sample of the key's rows by *all* columns of
the order, so a burst at one moment is cut as well.  What a slice amounts to
(its count, its last known value, its maximum) is folded over the slices of the
key, and what a slice inherits from those before it enters its window as a row
of its own in front of the others.  So the rows are shuffled once and joined
with nothing but the bounds; all other keys are one slice.

``running`` computes several such values in one window.  The sample decides how
even slices are, never a result.  Which keys are hot is counted first; that
aggregation reads the key columns only and combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.operators.sizing import maybe_broadcast, row_hash, row_salt
from signalloom.sources.scratch import materialize

DEFAULT_SLICE = "hour"
HOT_ROWS = 2_000_000
#: Rows of a table without a key from which on it is cut.
WHOLE_ROWS = 250_000
#: Slices of a hot key are at most so many, a power of two, and get so many sampled rows each.
MAX_SLICES = 1024
SAMPLED = 32


def time_slice(ts: str | Column, unit: str = DEFAULT_SLICE) -> Column:
    return F.date_trunc(unit, ts)


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


@dataclass(frozen=True)
class Fold:
    """A value that a row has from the rows of its key up to it, or before it.

    ``own`` is what one row adds.  ``of_slice`` sums up a slice, ``inherited``
    all slices before one, and ``at_row`` reads the value where the first row of
    a slice holds what was inherited.
    """

    own: Column

    def before_slice(self, hot: DataFrame, v: str, at: Column, parts: Sequence[str]) -> DataFrame:
        """Rows of hot keys with what ``of_slice`` needs beside ``v``."""
        return hot

    def first_step(self, v: str, w: WindowSpec) -> Column | None:
        """A column ``<v>_1`` for ``at_row``, as window functions cannot be nested."""
        return None

    def of_slice(self, v: str, at: Column) -> Column:
        raise NotImplementedError

    def inherited(self, v: str, earlier: WindowSpec) -> Column:
        raise NotImplementedError

    def at_row(self, v: str, w: WindowSpec) -> Column:
        raise NotImplementedError


class Sum(Fold):
    """Sum up to and including the row."""

    def of_slice(self, v: str, at: Column) -> Column:
        return F.sum(v)

    def inherited(self, v: str, earlier: WindowSpec) -> Column:
        return F.sum(v).over(earlier)

    def at_row(self, v: str, w: WindowSpec) -> Column:
        return F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0))


def count_rows() -> Fold:
    """The 1-based number of the row."""
    return Sum(F.lit(1).cast("long"))


class LastKnown(Fold):
    """The last value that is not null, up to and including the row."""

    def of_slice(self, v: str, at: Column) -> Column:
        return F.max_by(v, F.when(F.col(v).isNotNull(), at))

    def inherited(self, v: str, earlier: WindowSpec) -> Column:
        return F.last(v, True).over(earlier)

    def at_row(self, v: str, w: WindowSpec) -> Column:
        return F.last(v, True).over(w.rowsBetween(Window.unboundedPreceding, 0))


class EarlierMax(Fold):
    """The greatest value of the rows before the row, null for the first."""

    def of_slice(self, v: str, at: Column) -> Column:
        return F.max(v)

    def inherited(self, v: str, earlier: WindowSpec) -> Column:
        return F.max(v).over(earlier)

    def at_row(self, v: str, w: WindowSpec) -> Column:
        return F.max(v).over(w.rowsBetween(Window.unboundedPreceding, -1))


class Previous(Fold):
    """The struct ``own`` of the row before."""

    def of_slice(self, v: str, at: Column) -> Column:
        return F.max_by(v, at)

    def inherited(self, v: str, earlier: WindowSpec) -> Column:
        return F.last(v, True).over(earlier)

    def at_row(self, v: str, w: WindowSpec) -> Column:
        return F.lag(v).over(w)


class SinceReset(Fold):
    """How many rows have passed since the last row where ``own`` (a condition) held, or since the first."""

    def __init__(self, reset: Column):
        held = F.coalesce(reset, F.lit(False))
        super().__init__(F.struct(F.when(held, 0).otherwise(1).cast("long").alias("n"), held.alias("reset")))

    def before_slice(self, hot: DataFrame, v: str, at: Column, parts: Sequence[str]) -> DataFrame:
        last = F.max(F.when(F.col(v)["reset"], at)).over(Window.partitionBy(*parts))
        return hot.withColumn(f"{v}_after", F.coalesce(at > last, F.lit(True)))

    def of_slice(self, v: str, at: Column) -> Column:
        return F.struct(F.count_if(f"{v}_after").alias("n"), F.bool_or(F.col(v)["reset"]).alias("reset"))

    def inherited(self, v: str, earlier: WindowSpec) -> Column:
        slices = F.collect_list(v).over(earlier)  # at most MAX_SLICES
        none = F.lit(0).cast("long")
        n = F.aggregate(slices, none, lambda n, s: s["n"] + F.when(s["reset"], none).otherwise(n))
        return F.struct(n.alias("n"), F.lit(False).alias("reset"))

    def first_step(self, v: str, w: WindowSpec) -> Column | None:
        return F.sum(F.col(v)["n"]).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def at_row(self, v: str, w: WindowSpec) -> Column:
        passed = F.col(f"{v}_1")
        then = F.max(F.when(F.col(v)["reset"], passed)).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return passed - F.coalesce(then, F.lit(0))


def _bounds(df: DataFrame, keys: list[str], at: Column, hot_rows: int) -> DataFrame | None:
    """(``__k_*``, ``__bounds``) of the keys with more than ``hot_rows`` rows; None without any."""
    named = [F.col(k).alias(f"__k_{k}") for k in keys]
    counted = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__n"))
    hot = materialize(counted.filter(F.col("__n") > hot_rows), "hot-keys")
    if hot.isEmpty():
        return None
    pieces = F.col("__n") / max(hot_rows // 4, 1)
    slices = F.least(F.lit(MAX_SLICES), F.pow(F.lit(2), F.ceil(F.log2(pieces)))).cast("int")
    rated = hot.withColumn("__slices", slices).withColumn("__rate", F.greatest(F.floor(F.col("__n") / (F.col("__slices") * SAMPLED)), F.lit(1)))
    picked = df.select(*keys, at.alias("__at"))
    if keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        picked = picked.join(maybe_broadcast(rated), cond).drop(*keys)
    else:
        row = rated.first()  # one row
        picked = picked.withColumns({"__slices": F.lit(row["__slices"]), "__rate": F.lit(row["__rate"])})
    groups = [f"__k_{k}" for k in keys]
    picked = picked.where(F.pmod(F.xxhash64("__at"), F.col("__rate")) == 0).distinct()
    ranked = picked.groupBy(*groups).agg(F.array_sort(F.collect_list("__at")).alias("__s"), F.first("__slices").alias("__m"))
    size = F.size("__s")
    cuts = F.transform(F.sequence(F.lit(1), F.col("__m") - 1), lambda i: F.get("__s", F.floor(i * size / F.col("__m")).cast("int")))
    return materialize(ranked.select(*groups, F.when(F.col("__m") > 1, F.array_distinct(cuts)).otherwise(F.slice("__s", 1, 0)).alias("__bounds")), "bounds")


def _slice_no(bounds: Column, at: Column) -> Column:
    """How many of the ascending ``bounds`` are not above ``at``, by halving."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(MAX_SLICES.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(bounds, n + s - 1) <= at, n + s).otherwise(n))


def _sliced(
    df: DataFrame, keys: list[str], order: Sequence[str], hot_rows: int, slice_by: Column | None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows with ``__slice`` (null for keys that are not hot), and the hot rows among them.

    A slice is a struct, so that rows of a hot key whose ``slice_by`` is null are
    a slice as well: the first, as nulls are first in the order.
    """
    at = F.struct(*order)
    cuts = _bounds(df, keys, at, hot_rows)
    if cuts is None:
        return df.withColumn("__slice", F.lit(None)), None
    if keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        marked = df.join(maybe_broadcast(cuts), cond, "left")
    else:
        marked = df.withColumn("__bounds", cuts.select("__bounds").scalar())
    no = slice_by if slice_by is not None else _slice_no(F.col("__bounds"), at)
    sliced = marked.withColumn("__slice", F.when(F.col("__bounds").isNotNull(), F.struct(no.alias("at"))))
    sliced = sliced.drop("__bounds", *[f"__k_{k}" for k in keys])
    return sliced, sliced.filter(F.col("__slice").isNotNull())


def running(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    folds: dict[str, Fold],
    hot_rows: int | None = None,
    slice_by: Column | None = None,
) -> DataFrame:
    """``df`` with a column per fold, for each key of ``by`` (the whole table without any) in ``order``.

    ``order`` must be total; rows equal in all of it stay together.  ``slice_by``
    replaces the quantiles: any non-decreasing function of the order.
    """
    keys = _keys(by)
    if hot_rows is None:
        hot_rows = HOT_ROWS if keys else WHOLE_ROWS
    parts, columns = [*keys, "__slice"], df.columns
    own = {name: f"__v_{name}" for name in folds}
    rows, hot = _sliced(df.withColumns({own[n]: f.own for n, f in folds.items()}), keys, order, hot_rows, slice_by)
    rows = rows.withColumn("__own", F.lit(True))
    if hot is not None:
        at = F.struct(*order)
        for n, f in folds.items():
            hot = f.before_slice(hot, own[n], at, parts)
        ends = hot.groupBy(*parts).agg(*[f.of_slice(own[n], at).alias(own[n]) for n, f in folds.items()])
        earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*parts, *[f.inherited(own[n], earlier).alias(own[n]) for n, f in folds.items()])
        rows = rows.unionByName(carried.withColumn("__own", F.lit(False)), allowMissingColumns=True)
        w = Window.partitionBy(*parts).orderBy("__own", *order)
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
    steps = {f"{own[n]}_1": f.first_step(own[n], w) for n, f in folds.items()}
    rows = rows.withColumns({n: c for n, c in steps.items() if c is not None})
    out = rows.select("*", *[f.at_row(own[n], w).alias(f"__r_{n}") for n, f in folds.items()])
    return out.filter("__own").select(*columns, *[F.col(f"__r_{n}").alias(n) for n in folds])


def number_rows(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    slice_by: Column | None = None,
    name: str = "row_no",
    hot_rows: int | None = None,
) -> DataFrame:
    """1-based position of each row in its key; ``order`` must be total."""
    return running(df, by, order, {name: count_rows()}, hot_rows, slice_by)


def with_previous(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    slice_by: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``lag``: adds, for each ``source: name``, the value in the previous row of the key."""
    picked = F.struct(*[F.col(s).alias(n) for s, n in columns.items()])
    out = running(df, by, order, {"__prev": Previous(picked)}, hot_rows, slice_by)
    return out.select(*df.columns, *[F.col("__prev")[n].alias(n) for n in columns.values()])


def with_last_known(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    known: dict[str, Column],
    slice_by: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Forward fill: per ``name: expr`` the last non-null ``expr`` up to and including the row."""
    return running(df, by, order, {n: LastKnown(e) for n, e in known.items()}, hot_rows, slice_by)


def with_earlier_max(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    slice_by: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """The greatest ``value`` in the rows of the key before the row (null for the first)."""
    return running(df, by, order, {name: EarlierMax(value)}, hot_rows, slice_by)


def as_of(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    at: tuple[str, str],
    take: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` that is not after it, null before the first.

    ``at`` names the column to compare on each side, of one type; ``by`` columns
    that both have and that must be equal.  Rows of both are merged in order and
    filled forward, so ``left`` is shuffled once, however its rows are spread over
    time and keys, and joined with nothing.  Of several right rows at one place
    any is taken.  A null in ``by`` or ``at`` finds nothing.
    """
    keys = _keys(by)
    usable = right.where(F.col(at[1]).isNotNull())
    for k in keys:
        usable = usable.where(F.col(k).isNotNull())
    marks = usable.select(
        *keys,
        F.col(at[1]).alias("__at"),
        F.lit(0).alias("__side"),
        F.lit(0).cast("long").alias("__tie"),
        F.struct(*take).alias("__mark"),
    )
    rows = left.withColumns({"__at": F.col(at[0]), "__side": F.lit(1), "__tie": row_hash(left)})
    both = rows.unionByName(marks, allowMissingColumns=True)
    filled = running(both, keys, ("__at", "__side", "__tie"), {"__found": LastKnown(F.col("__mark"))}, hot_rows)
    return filled.where("__side = 1").select(*left.columns, *[F.col("__found")[c].alias(c) for c in take])


#: Pieces of the order whose sums are taken first.
GRID = 1024
#: Up to so many rows per key Spark cuts every task down to them before it shuffles.
GROUP_LIMIT = 1000


def _place(df: DataFrame, column: str) -> Column | None:
    """An order column as a number that does not decrease with it; None if it has no distances."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column).cast("timestamp_ntz")).cast("double")
    return None


def keep_within(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    weight: Column,
    limit: int,
    from_end: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Rows of each key, in order, as long as the sum of their weights is at most ``limit``.

    Weights are not negative; rows without one (null) are left out and take no
    room.  ``from_end`` begins with the last row.  Sums are
    taken in two levels: per key and piece of the first order column, which
    combines before it shuffles, and then, row by row, only in the one piece
    where the limit is reached.  All other rows are kept or dropped by the piece
    they lie in and are not shuffled.  A weight may be costly: beside the sums it
    is computed only for rows whose piece is not dropped.
    """
    keys, piece, weight = _keys(by), F.lit(0), weight.cast("long")
    place = _place(df, order[0])
    if place is not None:
        span = df.agg(F.min(place).alias("low"), F.max(place).alias("high")).first()
        if span["low"] is not None and span["low"] < span["high"]:
            share = (place - span["low"]) / (span["high"] - span["low"])
            # nulls are first in the order
            piece = F.when(place.isNull(), -1).otherwise(F.least(F.floor(share * GRID), F.lit(GRID - 1))).cast("int")
        else:
            piece = F.when(place.isNull(), -1).otherwise(0)
    placed = df.withColumn("__piece", piece)
    sums = placed.groupBy(*keys, "__piece").agg(F.coalesce(F.sum(weight), F.lit(0)).alias("__of_piece"))
    onward = F.desc("__piece") if from_end else F.asc("__piece")
    upto = F.sum("__of_piece").over(Window.partitionBy(*keys).orderBy(onward).rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("__upto") - F.col("__of_piece")
    ends = sums.withColumn("__upto", upto).where((F.col("__upto") > limit) & (before <= limit))
    ends = ends.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__piece").alias("__end"), "__of_piece", (F.lit(limit) - before).alias("__rest"))
    ends = materialize(ends, "ends")
    if keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        marked = placed.join(maybe_broadcast(ends), cond, "left").drop(*[f"__k_{k}" for k in keys])
    else:
        row = ends.first() or {"__end": None, "__of_piece": None, "__rest": None}  # one row at most
        marked = placed.withColumns({c: F.lit(row[c]).cast("long") for c in ("__end", "__of_piece", "__rest")})
    kept = F.col("__piece") > F.col("__end") if from_end else F.col("__piece") < F.col("__end")
    # (one condition, so that the weight is not asked for before the piece)
    whole = marked.where(F.when(F.col("__end").isNull() | kept, weight.isNotNull()))
    last = marked.where(F.col("__piece") == F.col("__end")).withColumn("__w", weight)
    summed = running(last, keys, order, {"__sum": Sum(F.coalesce("__w", F.lit(0)))}, hot_rows).where("__w is not null")
    used = F.col("__of_piece") - F.col("__sum") + F.col("__w") if from_end else F.col("__sum")
    return whole.select(*df.columns).unionByName(summed.where(used <= F.col("__rest")).select(*df.columns))


def keep_first(df: DataFrame, n: int, by: Sequence[str], order: Sequence[str], latest: bool = False, salts: int = 32) -> DataFrame:
    """First ``n`` rows in ``order`` per key (of the whole table without ``by``), or the last ones.

    Up to ``GROUP_LIMIT`` rows are cut inside (key, salt) first, so that the last
    step sees at most ``salts * n`` rows of a key however many there are; Spark cuts
    every map task down as well.  More are selected by counts (``keep_within``).
    """
    if n > GROUP_LIMIT:
        return keep_within(df, by, order, F.lit(1), n, latest)
    sorting = [F.col(c).desc() if latest else F.col(c).asc() for c in order]
    if not by:
        return df.orderBy(*sorting).limit(n)
    salted = df.withColumn("__salt", row_salt(df.select(*order), salts))
    return _first_of_group(_first_of_group(salted, n, [*by, "__salt"], sorting).drop("__salt"), n, by, sorting)


def _first_of_group(df: DataFrame, n: int, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
