from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from daystrata.functions import scalar
from daystrata.schema import ACTIVITY_BINS, ACTIVITY_FLAGS, BMI_BINS, SLEEP_BINS


def labels(spark, values, bins, default, closed="left", type_="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_}")
    return [r[0] for r in df.select(scalar.bin_label("v", bins, default, closed)).collect()]


def test_activity_edges(spark):
    values = [-1, 0, 4999, 5000, 9999, 10000, 14999, 15000, 10**6, None]
    assert labels(spark, values, ACTIVITY_BINS, "active", type_="int") == [
        "sedentary", "sedentary", "sedentary", "light", "light", "moderate", "moderate", "active", "active", "active",
    ]


def test_sleep_edges(spark):
    values = [-0.5, 0.0, 5.99, 6.0, 7.99, 8.0, 9.99, 10.0, 23.9, 24.0, float("nan"), None]
    assert labels(spark, values, SLEEP_BINS, "poor") == [
        "poor", "poor", "poor", "fair", "fair", "good", "good", "excellent", "excellent", "poor", "poor", "poor",
    ]


def test_bmi_edges(spark):
    values = [18.4, 18.5, 24.95, 25.0, 29.9, 30.0, None]
    assert labels(spark, values, BMI_BINS, "obese") == [
        "underweight", "normal", "normal", "overweight", "overweight", "obese", "obese",
    ]


def test_right_closed_bins(spark):
    bins = ((0, "low"), (10, "high"))
    assert labels(spark, [0.0, 10.0, 10.5], bins, None, "right") == [None, "low", "high"]
    with pytest.raises(ValueError):
        scalar.bin_label("v", bins, closed="both")


def test_flags_sum_to_one_inside_the_ranges(spark):
    df = spark.createDataFrame([(s,) for s in (0, 4999, 5000, 9999, 10000, 14999, 15000, 50000)], "steps int")
    flags = scalar.one_hot_bins(df, "steps", ACTIVITY_FLAGS, "activity_level")
    total = sum((F.col(f"activity_level_{label}") for label in ACTIVITY_FLAGS), F.lit(0))
    assert {r[0] for r in flags.select(total).collect()} == {1}
    outside = spark.createDataFrame([(-1,), (None,)], "steps int")
    flags = scalar.one_hot_bins(outside, "steps", ACTIVITY_FLAGS, "activity_level")
    assert {r[0] for r in flags.select(total).collect()} == {0}


def test_dates_are_parsed_strictly(spark):
    texts = [
        "2024-09-06", "2024-02-29", "2023-02-29", "2024-9-6", "garbage", "", None, " 2024-09-06", "2024-09-06 ",
        "2024-09-06\n", "2024-13-01", "2024/09/06", "2024-09-06T00:00:00", "20240906",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    fast = [r[0] for r in df.select(scalar.parsed_date("d")).collect()]
    assert fast[:2] == [datetime.date(2024, 9, 6), datetime.date(2024, 2, 29)]
    assert set(fast[2:]) == {None}
    slow = [r[0] for r in df.select(F.try_to_date("d", "yyyy-MM-dd")).collect()]
    assert fast == slow
    other = spark.createDataFrame([("06.09.2024",), ("2024-09-06",)], "d string")
    assert [r[0] for r in other.select(scalar.parsed_date("d", "dd.MM.yyyy")).collect()] == [
        datetime.date(2024, 9, 6),
        None,
    ]


def test_calendar_parts_follow_python(spark):
    first = datetime.date(2023, 12, 25)
    days = [first + datetime.timedelta(days=i) for i in range(400)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    for row in scalar.date_parts(df).withColumn("key", scalar.date_key("date")).collect():
        d = row.date
        assert (row.year, row.month, row.day) == (d.year, d.month, d.day)
        assert row.weekday == d.strftime("%A")
        assert row.weekday_num == d.weekday()
        assert row.is_weekend == int(d.weekday() >= 5)
        assert row.key == int(d.strftime("%Y%m%d"))


def test_body_metrics(make_log):
    rows = make_log({}, {"gender": "F"}, {"gender": None}, {"bmi": 0.0}, {"bmi": None})
    male, female, unknown, zero, missing = scalar.body_metrics(rows).collect()
    assert male.height_m == pytest.approx(1.8)
    assert male.height_cm == pytest.approx(180)
    assert male.bmr == pytest.approx(10 * 81 + 6.25 * 180 - 5 * 30 + 5)
    assert male.caloric_balance == pytest.approx(2300 - male.bmr)
    assert female.bmr == pytest.approx(male.bmr - 166)
    assert unknown.bmr == pytest.approx(female.bmr)
    assert (zero.height_m, zero.bmr, missing.height_cm, missing.caloric_balance) == (None,) * 4


def test_change_label_and_clamp(spark):
    df = spark.createDataFrame([(v,) for v in (3, 2, 0, -2, -3, None, 9, -9)], "c int")
    assert [r[0] for r in df.select(scalar.change_label("c")).collect()] == [
        "more_stress", "no_changes", "no_changes", "no_changes", "less_stress", "no_changes", "more_stress",
        "less_stress",
    ]
    assert [r[0] for r in df.select(scalar.clamped("c", 5)).collect()] == [3, 2, 0, -2, -3, None, 5, -5]
