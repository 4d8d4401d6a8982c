"""Cleaning: clipping, range rules, duplicates, dates, null handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.functions.scalar import ISO_DATE, parsed_date
from daystrata.schema import NON_NEGATIVE, RANGE_RULES

Rules = Mapping[str, tuple[float, float]]


def clip_negative(df: DataFrame, cols: Iterable[str] = NON_NEGATIVE) -> DataFrame:
    """Negative values become 0; nulls stay null and types stay as they are."""
    return df.withColumns({c: clip_expr(df, c) for c in cols})


def clip_expr(df: DataFrame, col: str) -> Column:
    return F.when(F.col(col) < 0, F.lit(0).cast(df.schema[col].dataType)).otherwise(F.col(col))


def in_range(rules: Rules, clipped: Iterable[str] = ()) -> Column:
    """All range rules as one predicate over the raw columns, so that it reaches the Parquet scan.

    For a column in ``clipped`` the rule is meant to see the clipped value. Where the lower bound is above 0 a
    clipped value fails anyway, and where 0 is allowed a negative value passes the lower bound; either way no
    CASE is needed around the column. Null fails every rule.
    """
    clipped = set(clipped)
    tests = []
    for name, (low, high) in rules.items():
        value = F.col(name)
        if name in clipped and high < 0:
            tests.append(F.lit(False))
        elif name in clipped and low <= 0:
            tests.append(value <= high)
        else:
            tests.append((value >= low) & (value <= high))
    return reduce(lambda left, right: left & right, tests, F.lit(True))


def range_filter(df: DataFrame, rules: Rules = RANGE_RULES) -> DataFrame:
    """Keep rows whose ruled columns all lie in their inclusive ranges; a null drops the row."""
    return df.filter(in_range(rules))


def drop_nonpositive(df: DataFrame, col: str = "steps") -> DataFrame:
    return df.filter(F.col(col) > 0)


def dedup_rows(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per distinct content; of the ``exclude`` columns the smallest value among the copies is kept, null last.

    A hash aggregate, so copies collapse before the shuffle, however many there are.
    """
    exclude = [c for c in exclude if c in df.columns]
    if not exclude:
        return df.dropDuplicates()
    content = [c for c in df.columns if c not in exclude]
    if len(exclude) == 1:
        return df.groupBy(*content).agg(F.min(exclude[0]).alias(exclude[0])).select(*df.columns)
    null_last = [part for c in exclude for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    kept = df.groupBy(*content).agg(F.min(F.struct(*null_last)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}").alias(c) if c in exclude else F.col(c) for c in df.columns])


def parse_date(df: DataFrame, col: str = "date", fmt: str = ISO_DATE) -> DataFrame:
    """Strings become dates; malformed ones become null."""
    return df.withColumn(col, parsed_date(col, fmt))


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of ``cols``; plain predicates, which reach a Parquet scan."""
    types = dict(df.dtypes)
    for c in cols:
        present = F.col(c).isNotNull()
        df = df.filter(present & ~F.isnan(c) if types[c] in ("double", "float") else present)
    return df


def drop_null_keys(df: DataFrame, keys: Sequence[str] = ("user_id", "date")) -> DataFrame:
    return drop_missing(df, keys)


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def clean_rows(
    df: DataFrame,
    rules: Rules = RANGE_RULES,
    clip: Sequence[str] = NON_NEGATIVE,
    positive: str = "steps",
    day: str = "date",
    keys: Sequence[str] = ("user_id", "date"),
    fmt: str = ISO_DATE,
) -> DataFrame:
    """Clip, range rules, no-step days, date parsing and null keys in one narrow stage (no duplicates removed).

    The filter comes first, on raw columns; only columns that can still be negative afterwards are clipped.
    """
    kept = df.filter(in_range(rules, clip) & (F.col(positive) > 0))
    certain = {c for c, (low, _) in rules.items() if low >= 0 and (low > 0 or c not in clip)} | {positive}
    kept = clip_negative(kept, [c for c in clip if c not in certain])
    if dict(kept.dtypes)[day] == "string":
        kept = parse_date(kept, day, fmt)
    return drop_null_keys(kept, keys)


def clean_log(df: DataFrame, exclude: Sequence[str] = (), **options) -> DataFrame:
    """``clean_rows`` and then one row per distinct content."""
    return dedup_rows(clean_rows(df, **options), exclude)
