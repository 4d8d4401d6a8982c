"""Data-quality reports. Each is one scan with map-side combine; only finished figures are ever brought together."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.operators.clean import Rules
from daystrata.schema import INGEST_TS, NON_NEGATIVE, RANGE_RULES

# Error bound of the quantile sketch is 1 / SKETCH_ACCURACY of the rows.
# Ranges that values are counted in where a sketch does not bracket the median.
RANGES = 256
# Octaves below 1 that a double reaches, and those from which on a bracket is wide.
OCTAVES = 1_100
WIDE = 64
SKETCH_ACCURACY = 10_000

# Most distinct values to sort in one task when the exact median is read off.
MEDIAN_VALUES = 4_000_000


def stamp(df: DataFrame, at: str | None = None, col: str = INGEST_TS) -> DataFrame:
    """Add the ingest time: now, the same for all rows, or a given timestamp."""
    return df.withColumn(col, F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))


def require_rows(df: DataFrame, message: str = "the source holds no rows") -> DataFrame:
    """Raise ValueError if ``df`` has no rows."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def _as_rows(totals: DataFrame, rows: Iterable[Mapping[str, Column]]) -> DataFrame:
    """Turn the one row of a global aggregate into one row per entry of ``rows``."""
    entries = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return totals.select(F.inline(F.array(*entries)))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(100.0 * part / whole, 2))


def null_counts(cols: Sequence[str]) -> dict[str, Column]:
    """Aggregates for the row count and the null count of every column."""
    counts = {"rows": F.count(F.lit(1))}
    counts |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in cols}
    return counts


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, rows, pct) for every column, from a single aggregate."""
    cols = list(cols or df.columns)
    totals = df.agg(*[agg.alias(name) for name, agg in null_counts(cols).items()])
    return _as_rows(
        totals,
        [
            {
                "column": F.lit(c),
                "nulls": F.col(f"null_{c}"),
                "rows": F.col("rows"),
                "pct": _percent(F.col(f"null_{c}"), F.col("rows")),
            }
            for c in cols
        ],
    )


def all_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns that hold nothing but nulls; none for an empty frame."""
    return null_profile(df, cols).filter((F.col("rows") > 0) & (F.col("nulls") == F.col("rows"))).select("column")


def duplicate_count(df: DataFrame, exclude: Sequence[str] = (INGEST_TS,)) -> DataFrame:
    """(rows, distinct_rows, duplicate_rows); copies collapse before the shuffle."""
    content = [c for c in df.columns if c not in exclude]
    groups = df.groupBy(*content).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    distinct = F.count(F.lit(1))
    return groups.agg(
        rows.alias("rows"), distinct.alias("distinct_rows"), (rows - distinct).alias("duplicate_rows")
    )


def _violations(rules: Rules, clip: Iterable[str]) -> dict[str, Column]:
    """Rule -> whether a row breaks it, seen after clipping; null breaks a rule, as it drops the row."""
    clip = set(clip)
    broken = {}
    for c, (low, high) in rules.items():
        value = F.when(F.col(c) < 0, 0).otherwise(F.col(c)) if c in clip else F.col(c)
        broken[c] = ~F.coalesce((value >= low) & (value <= high), F.lit(False))
    return broken


def outlier_counts(df: DataFrame, rules: Rules, clip: Iterable[str]) -> DataFrame:
    """One row: row count, and per rule the rows removed by it in rule order and the rows that break it at all."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    earlier = F.lit(False)
    for c, broken in _violations(rules, clip).items():
        aggregates.append(F.count_if(broken & ~earlier).alias(f"removed_{c}"))
        aggregates.append(F.count_if(broken).alias(f"violations_{c}"))
        earlier = earlier | broken
    return df.agg(*aggregates, F.count_if(earlier).alias("outliers"))


def outlier_report(df: DataFrame, rules: Rules = RANGE_RULES, clip: Iterable[str] = NON_NEGATIVE) -> DataFrame:
    """(column, removed, violations) per rule.

    ``removed`` counts a row under the first rule that it breaks, ``violations`` under every rule that it breaks.
    """
    return _as_rows(
        outlier_counts(df, rules, clip),
        [
            {"column": F.lit(c), "removed": F.col(f"removed_{c}"), "violations": F.col(f"violations_{c}")}
            for c in rules
        ],
    )


def outlier_rate(df: DataFrame, rules: Rules = RANGE_RULES, clip: Iterable[str] = NON_NEGATIVE) -> DataFrame:
    """(rows, outliers, pct)."""
    totals = outlier_counts(df, rules, clip)
    return totals.select("rows", "outliers", _percent(F.col("outliers"), F.col("rows")).alias("pct"))


def zero_audit(df: DataFrame, cols: Sequence[str] = ("steps", "sleep_hours")) -> DataFrame:
    """(column, zeros, rows) for columns in which 0 is suspicious."""
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c) == 0).alias(f"zero_{c}") for c in cols]
    )
    return _as_rows(
        totals, [{"column": F.lit(c), "zeros": F.col(f"zero_{c}"), "rows": F.col("rows")} for c in cols]
    )


def completeness(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rows_before, rows_after, pct_kept) of two stages, counted in one aggregate."""
    sides = before.select(F.lit(0).alias("kept")).unionAll(after.select(F.lit(1).alias("kept")))
    counts = sides.agg(F.count_if(F.col("kept") == 0).alias("rows_before"), F.count_if(F.col("kept") == 1).alias("rows_after"))
    return counts.withColumn("pct_kept", _percent(F.col("rows_after"), F.col("rows_before")))


def category_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, category, rows, pct) for every category of every column, nulls included."""
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols])
    counts = df.select(F.inline(names)).groupBy("column", "category").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy("column").agg(F.sum("rows").alias("_all"))
    # One row per requested column.
    shares = counts.join(F.broadcast(totals), "column")
    return shares.select("column", "category", "rows", _percent(F.col("rows"), F.col("_all")).alias("pct"))


def describe_numeric(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """(column, n, mean, median, stddev, min, max); mean and stddev are rounded to 2 digits.

    With ``approx`` the median comes from a quantile sketch in the same pass; otherwise it is exact.
    """
    moments = [agg for c in cols for agg in _moments(c)]
    names = ["column", "n", "mean", "median", "stddev", "min", "max"]
    if approx:
        sketches = [
            F.percentile_approx(F.col(c).cast("double"), 0.5, SKETCH_ACCURACY).alias(f"median_{c}") for c in cols
        ]
        return _as_rows(df.agg(*moments, *sketches), [{n: _figure(n, c) for n in names} for c in cols])
    totals = df.agg(*moments).first()
    names.remove("median")
    figures = [tuple(c if n == "column" else totals[f"{n}_{c}"] for n in names) for c in cols]
    schema = "column string, n long, mean double, stddev double, min double, max double"
    described = df.sparkSession.createDataFrame(figures, schema)
    # One row per requested column.
    medians = F.broadcast(exact_medians(df, cols, totals=totals))
    return described.join(medians, "column", "left").select("column", "n", "mean", "median", "stddev", "min", "max")


def _figure(name: str, col: str) -> Column:
    return F.lit(col) if name == "column" else F.col(f"{name}_{col}")


def age_distribution(df: DataFrame, col: str = "age", approx: bool = False) -> DataFrame:
    """(min, max, mean, median) of the age."""
    return describe_numeric(df, [col], approx).select("min", "max", "mean", "median")


def _moments(c: str) -> list[Column]:
    value = F.col(c).cast("double")
    return [
        F.count(c).alias(f"n_{c}"),
        F.round(F.avg(value), 2).alias(f"mean_{c}"),
        F.round(F.stddev_samp(value), 2).alias(f"stddev_{c}"),
        F.min(value).alias(f"min_{c}"),
        F.max(value).alias(f"max_{c}"),
    ]


class _Bracket:
    """Interval known to hold the middle ranks of a column: ``below`` values lie under it, ``inside`` in it."""

    def __init__(self, n: int, low: float, high: float):
        self.n, self.below, self.inside = n, 0, n
        self.low, self.high = low, high

    def holds(self, below: int, inside: int) -> bool:
        return below <= (self.n - 1) // 2 and self.n // 2 < below + inside


def exact_medians(
    df: DataFrame, cols: Sequence[str], max_values: int = MEDIAN_VALUES, totals: Row | None = None
) -> DataFrame:
    """(column, median), exact, without gathering a column in one task.

    A quantile sketch brackets the middle of each column. Exact counts below and inside the bracket confirm it,
    and sketches over the bracket narrow it until what it can hold is small enough to count by value and sort.
    Where a count does not confirm a bracket, the one before it is narrowed by counting values in ranges of equal
    width, which always comes to an end. The driver sees a few numbers per column: ``totals``, the counts and extremes
    of each column, which are looked up if not given, the edges of the brackets and the counts of ranges.
    """
    value = {c: F.col(c).cast("double") for c in cols}
    if totals is None:
        totals = df.agg(*[agg for c in cols for agg in _moments(c)]).first()
    brackets = {c: _Bracket(totals[f"n_{c}"], totals[f"min_{c}"], totals[f"max_{c}"]) for c in cols if totals[f"n_{c}"]}
    open_cols = [c for c, b in brackets.items() if b.inside > max_values]
    while open_cols:
        open_cols = _narrow(df, value, brackets, open_cols, max_values)
    return _read_median(df, value, brackets)


def _inside(value: Column, bracket: _Bracket) -> Column:
    return value.between(F.lit(float(bracket.low)), F.lit(float(bracket.high)))


def _narrow(df, value, brackets, open_cols, max_values) -> list[str]:
    """Narrow the brackets of ``open_cols`` once; returns those that are still too large and can be narrowed."""
    sketches = []
    for c in open_cols:
        b = brackets[c]
        ranks = [(b.n - 1) // 2 - b.below, b.n // 2 - b.below]
        margin = 2 / SKETCH_ACCURACY
        spread = [max(0.0, ranks[0] / b.inside - margin), min(1.0, (ranks[1] + 1) / b.inside + margin)]
        held = F.when(_inside(value[c], b), value[c])
        sketches.append(F.percentile_approx(held, spread, SKETCH_ACCURACY).alias(c))
    edges = df.agg(*sketches).first()
    counts = df.agg(
        *[F.count_if(value[c] < F.lit(float(edges[c][0]))).alias(f"below_{c}") for c in open_cols],
        *[F.count_if(value[c].between(*[F.lit(float(e)) for e in edges[c]])).alias(f"inside_{c}") for c in open_cols],
        *[
            F.count_if((value[c] > F.lit(float(edges[c][0]))) & (value[c] < F.lit(float(edges[c][1])))).alias(f"open_{c}")
            for c in open_cols
        ],
    ).first()
    remaining = []
    for c in open_cols:
        b = brackets[c]
        below, inside = counts[f"below_{c}"], counts[f"inside_{c}"]
        if not b.holds(below, inside) or inside >= b.inside:
            _narrow_by_ranges(df, value[c], b, max_values)
            continue
        b.low, b.high, b.below, b.inside = edges[c][0], edges[c][1], below, inside
        # Copies of the two edge values collapse when counted by value; only what lies between them counts.
        if counts[f"open_{c}"] > max_values:
            remaining.append(c)
    return remaining


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def _octave(value: float) -> float:
    """The octave of a number, counted from 0 outwards."""
    return math.copysign(math.log2(abs(value)) + OCTAVES, value) if value else 0.0


def _narrow_by_ranges(df: DataFrame, value: Column, b: _Bracket, max_values: int) -> None:
    """Narrow a bracket to the range, of equal width or of equally many octaves, that holds the middle, again and again.

    The least and the greatest value inside are never in the same range, so each pass leaves values out; it ends when
    few are left or all are equal. Infinite values and NaN have ranges of their own. One pass counts RANGES ranges.
    """
    edges = df.filter(_inside(value, b) & _finite(value)).agg(F.min(value), F.max(value)).first()
    low, high = edges
    while b.inside > max_values and b.low != b.high:
        below_all, above_all, no_number = F.lit(-1), F.lit(RANGES), F.lit(RANGES + 1)
        if low is None or low == high:
            place = F.lit(0)
        else:
            if _octave(high) - _octave(low) > WIDE:
                # Ranges of about as many octaves first, or small values would stay together pass after pass.
                octave = F.when(value == 0, 0.0).otherwise(F.signum(value) * (F.log2(F.abs(value)) + OCTAVES))
                share = (octave - _octave(low)) / (_octave(high) - _octave(low))
            else:
                # Halves, as the width of the bracket may be beyond what a double holds.
                share = (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
            place = F.greatest(F.lit(0), F.least(F.lit(RANGES - 1), F.floor(share * RANGES).cast("int")))
        place = F.when(F.isnan(value), no_number).when(_finite(value), place).otherwise(F.when(value > 0, above_all).otherwise(below_all))
        ranges = df.filter(_inside(value, b)).select(place.alias("place"), value.alias("value"))
        found = ranges.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        upto, middle = b.below, {}
        for row in sorted(found.collect()):  # at most RANGES + 3 rows
            for rank in ((b.n - 1) // 2, b.n // 2):
                if upto <= rank < upto + row["n"]:
                    middle[rank] = (row, upto)
            upto += row["n"]
        (first, before), (last, _) = middle[(b.n - 1) // 2], middle[b.n // 2]
        if first["place"] != last["place"]:
            # Nothing lies between the greatest value of one range and the least of the next.
            b.low, b.high = first["high"], last["low"]
            b.below, b.inside = df.agg(F.count_if(value < F.lit(float(b.low))), F.count_if(_inside(value, b))).first()
            return
        b.low, b.high, b.below, b.inside = first["low"], first["high"], before, first["n"]
        if not 0 <= first["place"] < RANGES:
            b.high = b.low
        low, high = b.low, b.high


def _read_median(df, value, brackets) -> DataFrame:
    """Count the values inside each bracket and take the middle one, or the mean of the middle two."""
    schema = T.StructType().add("column", "string").add("_below", "long").add("_n", "long")
    places = df.sparkSession.createDataFrame([(c, b.below, b.n) for c, b in brackets.items()], schema)
    held = [
        F.struct(F.lit(c).alias("column"), F.when(_inside(value[c], b), value[c]).alias("value"))
        for c, b in brackets.items()
    ]
    if not held:
        return places.select("column", F.lit(None).cast("double").alias("median"))
    values = df.select(F.inline(F.array(*held))).filter(F.col("value").isNotNull())
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_copies"))
    upto = F.sum("_copies").over(Window.partitionBy("column").orderBy("value"))
    # One row per requested column.
    ranked = counts.withColumn("_upto", upto).join(F.broadcast(places), "column")
    last = F.col("_below") + F.col("_upto")
    first = last - F.col("_copies")
    lower, upper = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    middle = ranked.filter((first <= upper) & (last > lower))
    weight = F.when(first <= lower, 1).otherwise(0) * F.when(last > lower, 1).otherwise(0)
    weight = weight + F.when((first <= upper) & (last > upper), 1).otherwise(0)
    return middle.groupBy("column").agg((F.sum(F.col("value") * weight) / F.sum(weight)).alias("median"))


def quality_issues(
    df: DataFrame,
    rules: Rules = RANGE_RULES,
    zero_cols: Sequence[str] = ("steps", "sleep_hours"),
    exclude: Sequence[str] = (INGEST_TS,),
) -> DataFrame:
    """(check, column, bad_rows) with bad_rows > 0: missing, out_of_range, zero per column, and duplicate ("*").

    Missing values, ranges and zeros take one scan; duplicates need their own aggregate over whole rows.
    ``out_of_range`` counts values present but outside their rule, before any clipping.
    """
    cols = [c for c in df.columns if c not in exclude]
    checks = [("missing", c, F.count_if(F.col(c).isNull())) for c in cols]
    checks += [
        ("out_of_range", c, F.count_if((F.col(c) < low) | (F.col(c) > high))) for c, (low, high) in rules.items()
    ]
    checks += [("zero", c, F.count_if(F.col(c) == 0)) for c in zero_cols]
    totals = df.agg(*[agg.alias(f"{check}_{c}") for check, c, agg in checks])
    issues = _as_rows(
        totals,
        [
            {"check": F.lit(check), "column": F.lit(c), "bad_rows": F.col(f"{check}_{c}")}
            for check, c, _ in checks
        ],
    )
    copies = duplicate_count(df, exclude).select(
        F.lit("duplicate").alias("check"), F.lit("*").alias("column"), F.col("duplicate_rows").alias("bad_rows")
    )
    return issues.unionByName(copies).filter(F.col("bad_rows") > 0)
