from __future__ import annotations

import datetime
import itertools
from functools import reduce

from pyspark.sql import functions as F

from daystrata.operators import clean
from daystrata.schema import NON_NEGATIVE, RANGE_RULES


def test_clip_keeps_nulls_and_types(make_log):
    df = make_log({"steps": -5, "sleep_hours": -1.0}, {"steps": None, "bmi": None}, {"steps": 7})
    clipped = clean.clip_negative(df)
    assert clipped.dtypes == df.dtypes
    first, second, third = clipped.collect()
    assert (first.steps, first.sleep_hours) == (0, 0.0)
    assert (second.steps, second.bmi) == (None, None)
    assert third.steps == 7
    assert clean.clip_negative(clipped).exceptAll(clipped).isEmpty()


def test_range_filter_bounds_are_inclusive(make_log):
    kept, dropped = [], []
    for name, (low, high) in RANGE_RULES.items():
        kind = int if name in ("age", "steps", "stress_level") else float
        kept += [{name: kind(low)}, {name: kind(high)}]
        dropped += [{name: kind(low - 1)}, {name: kind(high + 1)}, {name: None}]
    assert clean.range_filter(make_log(*kept)).count() == len(kept)
    assert clean.range_filter(make_log(*dropped)).isEmpty()
    assert clean.range_filter(make_log({"bmi": float("nan")}, {"weight_kg": float("nan")})).isEmpty()


def step_by_step(df):
    """Clip, then filter, as the rules are worded."""
    df = clean.clip_negative(df)
    df = clean.drop_nonpositive(clean.range_filter(df))
    return clean.drop_null_keys(clean.parse_date(df))


def test_early_filter_equals_clip_then_filter(make_log):
    values = {
        "steps": [None, -1, 0, 1, 50000, 50001],
        "exercise_minutes": [None, -20.0, 0.0, 600.0, 600.5, float("nan")],
        "sleep_hours": [None, -3.0, 0.0, 2.0, 16.0, 17.0],
        "calories_burned": [-1.0, 500.0, 8001.0],
    }
    rows = [dict(zip(values, combination)) for combination in itertools.product(*values.values())]
    df = make_log(*rows)
    fast, slow = clean.clean_rows(df), step_by_step(df)
    assert fast.exceptAll(slow).isEmpty() and slow.exceptAll(fast).isEmpty()
    assert fast.filter(F.col("exercise_minutes") < 0).isEmpty()
    assert fast.count() == 2 * 3 * 2 * 1


def test_early_filter_with_other_rules(make_log):
    rules = {"steps": (-10, 100), "weight_kg": (-50, -1), "bmi": (0, 60)}
    df = make_log(*[{"steps": s, "weight_kg": w, "bmi": b} for s in (-20, 5) for w in (-3.0, 4.0) for b in (-1.0, 30.0)])
    slow = clean.drop_null_keys(clean.parse_date(clean.drop_nonpositive(clean.range_filter(clean.clip_negative(df), rules))))
    fast = clean.clean_rows(df, rules)
    assert fast.exceptAll(slow).isEmpty() and slow.exceptAll(fast).isEmpty()
    rules = {"bmi": (-10, 60), "steps": (0, 100)}
    slow = clean.drop_null_keys(clean.parse_date(clean.drop_nonpositive(clean.range_filter(clean.clip_negative(df), rules))))
    fast = clean.clean_rows(df, rules)
    assert fast.count() == slow.count() == 4 and fast.exceptAll(slow).isEmpty()


def test_range_rules_reach_the_scan(spark, make_log, tmp_path):
    make_log({}, {"steps": 0}).write.parquet(str(tmp_path / "log"))
    plan = clean.clean_rows(spark.read.parquet(str(tmp_path / "log")))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for name in RANGE_RULES:
        assert f"LessThanOrEqual({name}" in pushed
    assert "GreaterThan(steps,0)" in pushed and "IsNotNull(user_id)" in pushed


def test_dedup_keeps_the_first_stamp(make_log):
    df = make_log({}, {}, {"steps": 9}, {"gender": None}, {"gender": None})
    assert clean.dedup_rows(df).count() == 3
    rows = [({}, 4), ({}, 0), ({"steps": 9}, 5), ({"gender": None}, 6), ({"gender": None}, 3)]
    stamped = reduce(
        lambda x, y: x.unionAll(y), [make_log(row).withColumns({"a": F.lit(at), "b": F.lit(-at)}) for row, at in rows]
    )
    one = clean.dedup_rows(stamped.drop("b"), exclude=["a"])
    assert sorted(r.a for r in one.collect()) == [0, 3, 5]
    two = clean.dedup_rows(stamped, exclude=["a", "b", "absent"])
    assert two.columns == stamped.columns
    assert sorted((r.a, r.b) for r in two.collect()) == [(0, 0), (3, -3), (5, -5)]


def test_dates_and_null_keys(make_log):
    df = make_log({}, {"date": "2024-9-6"}, {"date": None}, {"user_id": None})
    cleaned = clean.clean_log(df)
    assert [r.date for r in cleaned.collect()] == [datetime.date(2024, 9, 6)]


def test_missing_and_zero(make_log):
    df = make_log({"sleep_hours": None}, {"steps": None})
    assert clean.drop_missing(df, ["sleep_hours"]).count() == 1
    unknown = make_log({"sleep_hours": float("nan")}, {"sleep_hours": None}, {"gender": None}, {})
    for cols in (["sleep_hours"], ["gender", "sleep_hours"], ["steps"]):
        assert clean.drop_missing(unknown, cols).count() == unknown.na.drop(subset=cols).count()
    assert [r.steps for r in clean.fill_zero(df, ["steps"]).collect()] == [8000, 0]
    assert set(NON_NEGATIVE) <= set(df.columns)
