"""Column expressions: bins, calendar parts, body metrics, labels. All stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English weekday names, Monday first, whatever the locale of the JVM.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

ISO_DATE = "yyyy-MM-dd"
ISO_DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bin_label(
    value: Column | str,
    bins: Iterable[tuple[float | None, str | None]],
    default: str | None = None,
    closed: str = "left",
) -> Column:
    """Label of the bin that ``value`` falls in.

    ``bins`` lists (lower edge, label) in ascending order; ``None`` as the first edge means no lower bound and
    ``None`` as the last label closes the range. ``closed="right"`` puts an edge into the bin below it. Null and
    everything outside the bins get ``default``.
    """
    if closed not in ("left", "right"):
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    value = _col(value)
    case = None
    edges = list(bins)
    for (low, label), (high, _) in zip(edges, edges[1:] + [(None, None)]):
        if label is None:
            continue
        inside = value.isNotNull()
        if low is not None:
            inside = inside & ((value >= low) if closed == "left" else (value > low))
        if high is not None:
            inside = inside & ((value < high) if closed == "left" else (value <= high))
        case = F.when(inside, label) if case is None else case.when(inside, label)
    if case is None:
        return F.lit(default)
    return case.otherwise(default)


def range_flags(value: Column | str, ranges: Mapping[str, tuple[float, float]], prefix: str) -> dict[str, Column]:
    """One 0/1 column per inclusive range; null is in none of them."""
    value = _col(value)
    return {
        f"{prefix}_{label}": F.when(value.between(low, high), 1).otherwise(0)
        for label, (low, high) in ranges.items()
    }


def parsed_date(value: Column | str, fmt: str = ISO_DATE) -> Column:
    """Date of a string in exactly the given format, null for anything else.

    The ISO format is checked by its shape and cast, which is about 2.5 times faster than a formatter per row.
    """
    value = _col(value)
    if fmt == ISO_DATE:
        return F.when(value.rlike(ISO_DATE_SHAPE), value.try_cast("date"))
    return F.try_to_date(value, fmt)


def weekday_name(day: Column | str) -> Column:
    """Full English weekday name, by lookup rather than a date formatter."""
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), F.weekday(_col(day)) + 1)


def date_key(day: Column | str) -> Column:
    """Integer yyyymmdd."""
    day = _col(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_parts(day: Column | str) -> dict[str, Column]:
    """Year, month, day, weekday name, weekday number (Monday = 0) and 0/1 weekend flag."""
    day = _col(day)
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "weekday": weekday_name(day),
        "weekday_num": F.weekday(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


def height_m(weight: Column | str, bmi: Column | str) -> Column:
    """Height in metres from weight and BMI; null where BMI is not positive."""
    weight, bmi = _col(weight), _col(bmi)
    return F.when(bmi > 0, F.sqrt(weight / bmi))


def basal_rate(weight: Column | str, height_cm: Column | str, age: Column | str, gender: Column | str) -> Column:
    """Basal metabolic rate; every gender other than "M", null included, takes the second constant."""
    offset = F.when(_col(gender) == "M", 5).otherwise(-161)
    return 10 * _col(weight) + 6.25 * _col(height_cm) - 5 * _col(age) + offset


def change_label(change: Column | str, threshold: float = 3) -> Column:
    """more_stress / less_stress / no_changes; a null change counts as none."""
    change = _col(change)
    return (
        F.when(change >= threshold, "more_stress").when(change <= -threshold, "less_stress").otherwise("no_changes")
    )


def clamped(value: Column | str, limit: float) -> Column:
    """Value held within ±limit; null stays null."""
    value = _col(value)
    return F.when(value > limit, F.lit(limit)).when(value < -limit, F.lit(-limit)).otherwise(value)


def bucketize(df: DataFrame, col: str, bins, out: str, default: str | None = None, closed: str = "left") -> DataFrame:
    """Add the bin label of ``col`` as ``out``."""
    return df.withColumn(out, bin_label(col, bins, default, closed))


def one_hot_bins(df: DataFrame, col: str, ranges: Mapping[str, tuple[float, float]], prefix: str) -> DataFrame:
    """Add one 0/1 column per range of ``col``."""
    return df.withColumns(range_flags(col, ranges, prefix))


def date_parts(df: DataFrame, col: str = "date") -> DataFrame:
    """Add the calendar parts of ``col``."""
    return df.withColumns(calendar_parts(col))


def body_metrics(
    df: DataFrame,
    weight: str = "weight_kg",
    bmi: str = "bmi",
    age: str = "age",
    gender: str = "gender",
    calories: str = "calories_burned",
) -> DataFrame:
    """Add height_m, height_cm, bmr and caloric_balance."""
    height = height_m(weight, bmi)
    rate = basal_rate(weight, height * 100, age, gender)
    return df.withColumns(
        {
            "height_m": height,
            "height_cm": height * 100,
            "bmr": rate,
            "caloric_balance": F.col(calories) - rate,
        }
    )


def delta_label(df: DataFrame, col: str, out: str = "stress_change_label", threshold: float = 3) -> DataFrame:
    """Add the more / less / no-change label of ``col``."""
    return df.withColumn(out, change_label(col, threshold))
