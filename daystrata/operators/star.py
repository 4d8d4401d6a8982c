"""Star schema over the enriched daily log: user, date and activity dimensions and the daily fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.functions.scalar import date_key, weekday_name
from daystrata.operators.history import duplicate_keys
from daystrata.operators.skew import GROUP_ROWS, large_groups, split_by_keys


def rounded(cols: Sequence[str], digits: int = 2) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in cols]


def build_dim_user(df: DataFrame, sort: bool = True) -> DataFrame:
    """Mean body measures per (user_id, age, gender), rounded to 2 digits."""
    measures = ("height_cm", "weight_kg", "bmi", "bmr")
    users = df.groupBy("user_id", "age", "gender").agg(
        *[F.round(F.avg(m), 2).alias(f"avg_{m}") for m in measures]
    )
    return users.orderBy("user_id", "age", "gender") if sort else users


def build_dim_date(df: DataFrame, sort: bool = True) -> DataFrame:
    """One row per calendar day; the parts follow from the day, so only the day itself is shuffled."""
    days = df.select("date").distinct()
    dates = days.select(
        date_key("date").alias("date_key"),
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        weekday_name("date").alias("weekday"),
    )
    return dates.orderBy("date") if sort else dates


def build_dim_activity(df: DataFrame, sort: bool = True) -> DataFrame:
    """Activity and sleep descriptors per user and day.

    Sorting is a range shuffle that only shapes the file layout. The other columns and a hash of the measures left
    out come after (user_id, date), so that a user, or even one day of a user, can spread over several ranges.
    """
    columns = ("user_id", "date", "steps", "exercise_minutes", "calories_burned", "activity_level", "sleep_quality")
    measures = ("heart_rate_avg", "sleep_hours", "stress_level", "weight_kg", "bmi")
    if sort:
        df = df.orderBy(*columns, F.xxhash64(*[c for c in measures if c in df.columns], F.lit(0)))
    return df.select(*columns)


# Columns of the daily fact in their order, those of them that are rounded, and those renamed.
FACT_COLUMNS = (
    "user_id", "date_key", "age", "gender", "sleep_hours", "heart_rate_avg", "stress_level", "steps",
    "exercise_minutes", "calories_burned", "weight_kg", "bmi", "height_cm", "bmr", "ra30_steps", "ra30_calories",
    "ra30_ex_minutes", "caloric_balance", "weight_change_30d", "yesterday_stress", "yesterday_sleep", "month", "year",
    "day", "weekday", "weekday_num", "is_weekend", "activity_level", "sleep_quality", "bmi_category", "ra30_stress",
    "stress_change_30d",
)
FACT_ROUNDED = (
    "ra30_steps", "ra30_calories", "ra30_ex_minutes", "caloric_balance", "weight_change_30d", "ra30_stress",
    "stress_change_30d",
)
FACT_RENAMED = {"yesterday_stress": "lag1_stress", "yesterday_sleep": "lag1_sleep_hours"}


def build_fact_daily(df: DataFrame) -> DataFrame:
    """Daily measures, long-term features and flags; a narrow projection of the enriched log."""
    made = {"date_key": date_key("date"), "weekday": weekday_name("date")}
    made |= {c: F.round(c, 2) for c in FACT_ROUNDED} | {c: F.col(old) for c, old in FACT_RENAMED.items()}
    known = df.filter(F.col("user_id").isNotNull())
    return known.select(*[made.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS])


def merge_outer(
    *frames: DataFrame,
    on: Sequence[str] = ("user_id", "date_key"),
    check_unique: bool = False,
    group_rows: int | None = None,
) -> DataFrame:
    """Full outer join of all frames on ``on``; later joins reuse the partitioning of the first.

    A key that occurs n times in one frame and m times in another gives n * m rows; ``check_unique`` refuses that.
    Keys with more than ``group_rows`` rows in a frame (default: GROUP_ROWS, looked for only in frames larger than
    one task) are joined apart, spread over several tasks.
    """
    on = list(on)
    if check_unique:
        for frame in frames:
            if not duplicate_keys(frame, on).isEmpty():
                raise ValueError(f"keys {on} are not unique")
    merged, *rest = frames
    large = large_groups(merged, on, group_rows)
    for frame in rest:
        more = large_groups(frame, on, group_rows)
        if large is not None and more is not None:
            large = large.unionByName(more).distinct()
        else:
            large = more if large is None else large
        merged = _outer(merged, frame, on, large, max(1, GROUP_ROWS if group_rows is None else group_rows))
    return merged


def _outer(left: DataFrame, right: DataFrame, on: list[str], large: DataFrame | None, cell_rows: int) -> DataFrame:
    if large is None:
        return left.join(right, on, "outer")
    left_rest, left_large = split_by_keys(left, on, large)
    right_rest, right_large = split_by_keys(right, on, large)
    joined = left_rest.join(right_rest, on, "outer")
    return joined.unionByName(_spread_outer(left_large, right_large, on, cell_rows))


def _spread_outer(left: DataFrame, right: DataFrame, on: list[str], cell_rows: int) -> DataFrame:
    """Full outer join of a few large keys.

    The matches of a key form a grid: its left rows are cut into parts and its right rows into parts, each of about
    ``cell_rows`` rows, and every left part meets every right part in a cell of its own. A row is repeated once per
    part of the other side, which is far less than the rows it produces. Rows without a match are found by comparing
    with the keys of the other side.
    """
    # At most one row per large key.
    sizes = _parts(left, on, "_left_parts", cell_rows).join(_parts(right, on, "_right_parts", cell_rows), on)
    sizes = F.broadcast(sizes)
    left_cells = _cells(left, sizes, on, "_left", "_right")
    right_cells = _cells(right, sizes, on, "_right", "_left")
    cells = left_cells.join(right_cells, [*on, "_left_part", "_right_part"])
    # One step per side, so that no array is longer than the copies of one row in one part.
    for side in ("_left", "_right"):
        cells = cells.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{side}_copies"))))
    matches = cells.select(*on, *[c for c in (*left.columns, *right.columns) if c not in on])
    left_only = left.join(F.broadcast(right.select(*on).distinct()), on, "left_anti")
    right_only = right.join(F.broadcast(left.select(*on).distinct()), on, "left_anti")
    result = matches.unionByName(left_only, allowMissingColumns=True)
    return result.unionByName(right_only, allowMissingColumns=True)


def _parts(df: DataFrame, on: list[str], name: str, cell_rows: int) -> DataFrame:
    """Number of parts that the rows of each key are cut into."""
    return df.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("long").alias(name))


def _cells(df: DataFrame, sizes: DataFrame, on: list[str], side: str, other: str) -> DataFrame:
    """Distinct rows with their number of copies, dealt out over the parts of their side, for every part of the other.

    Copies are counted before the shuffle and shared out among parts, so even a key of nothing but copies spreads.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_all")).join(sizes, on)
    parts = F.col(f"{side}_parts")
    shares = F.least(F.col("_all"), parts)
    dealt = counted.withColumn("_share", F.explode(F.sequence(zero, shares - one)))
    copies = F.floor(F.col("_all") / shares) + F.when(F.col("_share") < F.col("_all") % shares, one).otherwise(zero)
    dealt = dealt.withColumns(
        {
            f"{side}_copies": copies,
            f"{side}_part": F.pmod(F.pmod(F.xxhash64(*df.columns), parts) + F.col("_share"), parts),
        }
    )
    dealt = dealt.withColumn(f"{other}_part", F.explode(F.sequence(zero, F.col(f"{other}_parts") - one)))
    return dealt.select(*df.columns, f"{side}_part", f"{other}_part", f"{side}_copies")


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order, as a top-k rather than a full sort."""
    return df.orderBy(*order).limit(n)
