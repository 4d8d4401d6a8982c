"""Enriched (silver) daily log: cleaning, labels, calendar parts, history features and body metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.functions.scalar import basal_rate, bin_label, calendar_parts, height_m, range_flags
from daystrata.operators.clean import Rules, clean_rows
from daystrata.operators.history import Change, Previous, TrailingMean, history
from daystrata.schema import (
    ACTIVITY_BINS,
    ACTIVITY_FLAGS,
    BMI_BINS,
    INGEST_TS,
    NON_NEGATIVE,
    RANGE_RULES,
    SLEEP_BINS,
)


def history_features(clamp: float | None = None) -> dict[str, Previous]:
    """The nine history features of the enriched log; ``clamp`` holds the two changes within ±clamp."""
    return {
        "weight_prev": Previous("weight_kg"),
        "weight_change_30d": Change("weight_kg", clamp=clamp),
        "ra30_steps": TrailingMean("steps"),
        "ra30_calories": TrailingMean("calories_burned"),
        "ra30_ex_minutes": TrailingMean("exercise_minutes"),
        "lag1_stress": Previous("stress_level"),
        "lag1_sleep_hours": Previous("sleep_hours"),
        "ra30_stress": TrailingMean("stress_level"),
        "stress_change_30d": Change("stress_level", clamp=clamp),
    }


def label_columns() -> dict:
    """Activity flags and the activity, sleep and BMI labels; null steps, sleep and BMI fall to the last label."""
    return range_flags("steps", ACTIVITY_FLAGS, "activity_level") | {
        "activity_level": bin_label("steps", ACTIVITY_BINS, default="active"),
        "sleep_quality": bin_label("sleep_hours", SLEEP_BINS, default="poor"),
        "bmi_category": bin_label("bmi", BMI_BINS, default="obese"),
    }


def build_silver(
    df: DataFrame,
    rules: Rules = RANGE_RULES,
    clip: tuple[str, ...] = NON_NEGATIVE,
    frame: str = "rows",
    clamp: float | None = None,
    exclude: tuple[str, ...] = (INGEST_TS,),
    group_rows: int | None = None,
) -> DataFrame:
    """Clean the raw log and add all features.

    Only the raw columns travel through the shuffle; labels, calendar parts and body metrics are computed after it.
    """
    kept = clean_rows(df, rules, clip)
    rows = history(
        kept,
        history_features(clamp),
        frame=frame,
        distinct=True,
        exclude=exclude,
        group_rows=group_rows,
        sized_by=df.filter(F.col("user_id").isNotNull()),
    )
    return derived_columns(rows, df.columns)


def derived_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with history features get labels, calendar parts and body metrics; ``columns`` come first."""
    height = height_m("weight_kg", "bmi")
    rate = basal_rate("weight_kg", "height_cm", "age", "gender")
    rows = rows.withColumns({"height_m": height, "height_cm": height * 100}).withColumn("bmr", rate)
    derived = (
        label_columns()
        | calendar_parts("date")
        | {"caloric_balance": F.col("calories_burned") - F.col("bmr")}
    )
    order = [
        *columns,
        *[name for name in derived if name != "caloric_balance"],
        *history_features(),
        "height_m",
        "height_cm",
        "bmr",
        "caloric_balance",
    ]
    return rows.withColumns(derived).select(*order)
