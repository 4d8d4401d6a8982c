"""Column names, types, rules and labels of the daily log."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the daily-log file, in file order.
DAILY_LOG_FIELDS = {
    "user_id": "integer",
    "age": "integer",
    "gender": "string",
    "date": "string",
    "steps": "integer",
    "heart_rate_avg": "double",
    "sleep_hours": "double",
    "calories_burned": "double",
    "exercise_minutes": "double",
    "stress_level": "integer",
    "weight_kg": "double",
    "bmi": "double",
}

# Inclusive valid range per metric, in the order in which the rules are applied.
RANGE_RULES = {
    "age": (18, 100),
    "steps": (0, 50000),
    "heart_rate_avg": (30, 200),
    "sleep_hours": (2, 16),
    "calories_burned": (500, 8000),
    "exercise_minutes": (0, 600),
    "stress_level": (1, 10),
    "weight_kg": (30, 200),
    "bmi": (10, 60),
}

# Metrics that cannot be negative.
NON_NEGATIVE = (
    "steps",
    "heart_rate_avg",
    "sleep_hours",
    "calories_burned",
    "exercise_minutes",
    "weight_kg",
    "bmi",
)

# Bin edges and labels. A bin runs from its lower edge to the next one.
ACTIVITY_BINS = ((None, "sedentary"), (5000, "light"), (10000, "moderate"), (15000, "active"))
SLEEP_BINS = ((0, "poor"), (6, "fair"), (8, "good"), (10, "excellent"), (24, None))
BMI_BINS = ((None, "underweight"), (18.5, "normal"), (25, "overweight"), (30, "obese"))

# Inclusive ranges of the 0/1 activity flags.
ACTIVITY_FLAGS = {
    "sedentary": (0, 4999),
    "light": (5000, 9999),
    "moderate": (10000, 14999),
    "active": (15000, 999999),
}

USER = ("user_id",)
DAY = ("date",)
INGEST_TS = "ingest_ts"

# Rows before the current one that the 30-row windows reach back to.
WINDOW_ROWS = 30


def daily_log_schema(order: list[str] | None = None) -> T.StructType:
    """Schema of the daily-log file, optionally with the fields in another order."""
    schema = T.StructType()
    for name in order or DAILY_LOG_FIELDS:
        schema.add(name, DAILY_LOG_FIELDS[name])
    return schema
