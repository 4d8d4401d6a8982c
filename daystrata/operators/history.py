"""Lags, changes and trailing means over the rows of one key in day order.

All features of a frame are computed over one window definition: one shuffle on the key, one sort, one Window.
A key with too many rows for one task is cut into consecutive chunks, each preceded by the few rows its windows
reach back to, so that no group of any size ends up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daystrata.functions.scalar import clamped
from daystrata.operators.clean import dedup_rows
from daystrata.operators.skew import GROUP_ROWS, join_same, large_groups, split_by_keys
from daystrata.schema import DAY, USER, WINDOW_ROWS

TIE = "_tie"
SLICE = "_slice"
CHUNK = "_chunk"
HALO = "_halo"

# A day of a split key is cut into up to 2**SLICE_BITS slices of its rows.
SLICE_BITS = 12

INTEGRAL = ("tinyint", "smallint", "int")


@dataclass(frozen=True)
class Previous:
    """Value of ``col`` n rows (or exactly n days) earlier."""

    col: str
    n: int = 1

    @property
    def reach(self) -> int:
        return self.n

    def over_rows(self, window: WindowSpec, integral: bool = False) -> Column:
        return F.lag(self.col, self.n).over(window)

    def daily(self) -> dict[str, Column]:
        return {f"_max_{self.col}": F.max(self.col)}

    def over_daily(self, window: WindowSpec) -> Column:
        return F.max(f"_max_{self.col}").over(window.rangeBetween(-self.n, -self.n))

    def finish(self, value: Column) -> Column:
        return value


@dataclass(frozen=True)
class Change(Previous):
    """``col`` minus its value n rows (or exactly n days) earlier, optionally held within ±clamp."""

    n: int = WINDOW_ROWS
    clamp: float | None = None

    def finish(self, value: Column) -> Column:
        change = F.col(self.col) - value
        return change if self.clamp is None else clamped(change, self.clamp)


@dataclass(frozen=True)
class TrailingMean(Previous):
    """Mean of ``col`` over the current and the n - 1 earlier rows (or the last n days)."""

    n: int = WINDOW_ROWS

    @property
    def reach(self) -> int:
        return self.n - 1

    def over_rows(self, window: WindowSpec, integral: bool = False) -> Column:
        """A sliding frame adds up n rows for every row. For whole numbers, whose sums are exact, the difference of
        two running totals gives the same value with two additions; for fractions it would lose digits."""
        if not integral:
            return F.avg(self.col).over(window.rowsBetween(1 - self.n, 0))
        upto = window.rowsBetween(Window.unboundedPreceding, 0)
        before = window.rowsBetween(Window.unboundedPreceding, -self.n)
        value = F.col(self.col).cast("long")
        total = F.coalesce(F.sum(value).over(upto), F.lit(0)) - F.coalesce(F.sum(value).over(before), F.lit(0))
        rows = F.count(self.col).over(upto) - F.count(self.col).over(before)
        return F.when(rows > 0, total.cast("double") / rows.cast("double"))

    def daily(self) -> dict[str, Column]:
        return {f"_sum_{self.col}": F.sum(self.col), f"_n_{self.col}": F.count(self.col)}

    def over_daily(self, window: WindowSpec) -> Column:
        frame = window.rangeBetween(1 - self.n, 0)
        rows = F.sum(f"_n_{self.col}").over(frame)
        return F.when(rows > 0, F.sum(f"_sum_{self.col}").over(frame) / rows)


Features = Mapping[str, Previous]


def history(
    df: DataFrame,
    features: Features,
    keys: Sequence[str] = USER,
    order: Sequence[str] = DAY,
    frame: str = "rows",
    distinct: bool = False,
    exclude: Sequence[str] = (),
    group_rows: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add ``features`` (output name -> feature) to ``df``.

    Rows that agree on ``order`` come in the order of a hash of the whole row and then of its values, whatever path
    their key takes. ``distinct`` also removes duplicate rows, ignoring ``exclude``, in the same shuffle; of the copies
    the one with the smallest ``exclude`` values stays, null last.
    ``group_rows`` is the number of rows from which a key is split (default: GROUP_ROWS, looked for only in inputs
    larger than one task). ``sized_by`` is a frame to count the keys in instead of ``df``, such as the table that
    ``df`` was filtered from: its scan reads the key columns only, and more rows per key do no harm.
    """
    if frame not in ("rows", "days"):
        raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")
    if frame == "days" and len(order) != 1:
        raise ValueError("a frame in days needs exactly one order column, a date")
    if frame == "days":
        return _over_days(dedup_rows(df, exclude) if distinct else df, features, keys, order[0])
    large = large_groups(df if sized_by is None else sized_by, keys, group_rows)
    if large is None:
        return _plain_rows(df, features, keys, order, distinct, exclude)
    rest, big = split_by_keys(df, keys, large)
    if distinct:
        big = dedup_rows(big, exclude)
    rest = _plain_rows(rest, features, keys, order, distinct, exclude)
    big = _split_rows(big, features, keys, order, exclude, group_rows or GROUP_ROWS)
    return rest.unionByName(big)


def _row_values(df: DataFrame, features: Features, window: WindowSpec) -> dict[str, Column]:
    types = dict(df.dtypes)
    return {
        name: feature.over_rows(window, types[feature.col] in INTEGRAL) for name, feature in features.items()
    }


def _with_features(df: DataFrame, values: dict[str, Column], features: Features, keep: Sequence[str]) -> DataFrame:
    """Evaluate the window ``values`` together, then finish each feature from its window value."""
    windowed = df.select(*keep, *[value.alias(f"_w_{name}") for name, value in values.items()])
    done = [feature.finish(F.col(f"_w_{name}")).alias(name) for name, feature in features.items()]
    return windowed.select(*keep, *done)


def row_hash(columns: Sequence[str], exclude: Sequence[str]) -> Column:
    """Hash of the values and of which of them are null; the hash of the values alone passes nulls over."""
    content = [c for c in columns if c not in exclude]
    return F.xxhash64(*content, *[F.col(c).isNull() for c in content])


def _in_order(columns: Sequence[str], keys: Sequence[str], order: Sequence[str], exclude: Sequence[str]) -> list[str]:
    """Sort columns within a key: the order, the row hash, then all other values."""
    return [*order, TIE, *[c for c in columns if c not in keys and c not in order and c not in exclude]]


def _distinct_in_place(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], exclude: Sequence[str]
) -> DataFrame:
    """Shuffle by ``keys`` once and drop duplicates in the sort order that the feature window needs anyway.

    Sorting on (keys, order, row hash, all other columns) puts copies side by side; (keys, order, row hash) is a
    prefix of it, so the following Window adds neither a shuffle nor a sort.
    """
    exclude = [c for c in exclude if c in df.columns]
    content = [c for c in df.columns if c not in exclude]
    rest = [c for c in content if c not in keys and c not in order]
    rows = df.repartition(*keys).withColumn(TIE, row_hash(df.columns, exclude))
    copies = Window.partitionBy(*keys, *order, TIE, *rest).orderBy(*([F.asc_nulls_last(c) for c in exclude] or [TIE]))
    return rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") == 1).drop("_copy")


def _plain_rows(df, features, keys, order, distinct, exclude):
    columns = df.columns
    if distinct:
        # Rows are sorted already, by all values after the hash; ordering by the hash keeps them so.
        df = _distinct_in_place(df, keys, order, exclude)
        ordered = [*order, TIE]
    else:
        df = df.withColumn(TIE, row_hash(columns, exclude))
        ordered = _in_order(columns, keys, order, exclude)
    window = Window.partitionBy(*keys).orderBy(*ordered)
    values = _row_values(df, features, window)
    return _with_features(df, values, features, columns)


def _over_days(df, features, keys, day):
    """Day frames need only one pre-aggregated row per key and day, however many rows a day or a key has."""
    columns = df.columns
    aggregates = {name: agg for feature in features.values() for name, agg in feature.daily().items()}
    daily = df.groupBy(*keys, day).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    window = Window.partitionBy(*keys).orderBy(F.unix_date(day))
    daily = daily.select(
        *keys, day, *[feature.over_daily(window).alias(f"_w_{name}") for name, feature in features.items()]
    )
    joined = join_same(df, daily, [*keys, day])
    done = [feature.finish(F.col(f"_w_{name}")).alias(name) for name, feature in features.items()]
    return joined.select(*columns, *done)


def _split_rows(df, features, keys, order, exclude, group_rows):
    """Row frames over consecutive chunks of each key, with the rows before each chunk copied in front of it."""
    columns = df.columns
    reach = max(feature.reach for feature in features.values())
    # The leading bits of the hash, sign included, so that slices follow the order of the hash.
    rows = df.withColumn(TIE, row_hash(columns, exclude))
    rows = rows.withColumn(SLICE, F.shiftright(TIE, 64 - SLICE_BITS).cast("int"))

    cell = [*keys, *order, SLICE]
    chunks = _chunks(rows, keys, order, group_rows)
    own = chunks.select(*cell, CHUNK, F.lit(False).alias(HALO))
    routes = own.unionByName(_halo(chunks, keys, cell, reach))

    window = Window.partitionBy(*keys, CHUNK).orderBy(*_in_order(columns, keys, order, exclude))
    routed = join_same(rows, routes, cell)
    values = _row_values(routed, features, window)
    return _with_features(routed, values, features, [*columns, HALO]).filter(~F.col(HALO)).drop(HALO)


def _chunks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int) -> DataFrame:
    """(keys, order, slice) -> position of its first row in the key, its row count and its chunk.

    The positions come from row counts per slice, summed first within a day and then over days, so each of the
    two windows runs over at most 2**SLICE_BITS slices or over the days of one key.
    """
    counts = rows.groupBy(*keys, *order, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    within = Window.partitionBy(*keys, *order).orderBy(SLICE)
    before = Window.partitionBy(*keys).orderBy(*order)
    days = counts.groupBy(*keys, *order).agg(F.sum("_n").alias("_day_n"))
    days = days.select(*keys, *order, (F.sum("_day_n").over(before) - F.col("_day_n")).alias("_base"))
    placed = counts.withColumn("_inside", F.sum("_n").over(within) - F.col("_n"))
    placed = join_same(placed, days, [*keys, *order])
    start = F.col("_base") + F.col("_inside")
    return placed.select(
        *keys, *order, SLICE, start.alias("_start"), "_n", F.floor(start / chunk_rows).alias(CHUNK)
    )


def _halo(chunks: DataFrame, keys: Sequence[str], cell: Sequence[str], reach: int) -> DataFrame:
    """Slices that hold one of the ``reach`` rows before a chunk, with that chunk.

    A slice ending at position e is needed by a chunk starting at h when 0 <= h - e < reach; such an h lies in the
    same block of ``reach`` positions as e or in the next one, which makes it an equi-join.
    """
    ends = chunks.withColumn("_end", F.col("_start") + F.col("_n"))
    block = F.floor(F.col("_end") / reach)
    ends = ends.withColumn("_block", F.explode(F.array(block, block + 1)))
    heads = chunks.groupBy(*keys, CHUNK).agg(F.min("_start").alias("_head"))
    heads = heads.select(*keys, F.col(CHUNK).alias("_target"), "_head", F.floor(F.col("_head") / reach).alias("_block"))
    near = join_same(ends, heads, [*keys, "_block"]).filter(
        (F.col("_target") > F.col(CHUNK)) & F.col("_head").between(F.col("_end"), F.col("_end") + reach - 1)
    )
    return near.select(*cell, F.col("_target").alias(CHUNK), F.lit(True).alias(HALO))


def lag_features(
    df: DataFrame,
    lags: Mapping[str, tuple[str, int]],
    keys: Sequence[str] = USER,
    order: Sequence[str] = DAY,
    **options,
) -> DataFrame:
    """Add earlier values: output name -> (column, rows back)."""
    return history(df, {out: Previous(col, n) for out, (col, n) in lags.items()}, keys, order, **options)


def change_over(
    df: DataFrame,
    cols: Mapping[str, str],
    n: int = WINDOW_ROWS,
    keys: Sequence[str] = USER,
    order: Sequence[str] = DAY,
    clamp: float | None = None,
    **options,
) -> DataFrame:
    """Add changes over ``n`` rows: output name -> column."""
    return history(df, {out: Change(col, n, clamp) for out, col in cols.items()}, keys, order, **options)


def rolling_mean(
    df: DataFrame,
    cols: Mapping[str, str],
    n: int = WINDOW_ROWS,
    keys: Sequence[str] = USER,
    order: Sequence[str] = DAY,
    frame: str = "rows",
    **options,
) -> DataFrame:
    """Add trailing means over ``n`` rows or days: output name -> column."""
    return history(df, {out: TrailingMean(col, n) for out, col in cols.items()}, keys, order, frame=frame, **options)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
