from __future__ import annotations

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from daystrata.operators import quality
from daystrata.schema import DAILY_LOG_FIELDS


@pytest.fixture(scope="module")
def flawed(make_log):
    return make_log(
        {},
        {},
        {"steps": -5, "sleep_hours": 0.0},
        {"steps": 0, "age": 17, "bmi": 5.0},
        {"age": None, "steps": 60000, "gender": None},
        {"sleep_hours": None, "gender": None},
        {"exercise_minutes": -3.0, "date": None},
    )


def rows(df, *key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


def test_null_profile(flawed):
    found = rows(quality.null_profile(flawed), "column")
    assert list(found) == [(c,) for c in DAILY_LOG_FIELDS]
    assert {c: r.nulls for (c,), r in found.items() if r.nulls} == {"age": 1, "gender": 2, "sleep_hours": 1, "date": 1}
    assert found["gender",].rows == 7 and found["gender",].pct == 28.57


def test_all_null_columns(flawed, spark):
    df = flawed.withColumn("note", F.lit(None).cast("string"))
    assert [r[0] for r in quality.all_null_columns(df).collect()] == ["note"]
    assert quality.all_null_columns(df.limit(0)).isEmpty()
    assert quality.null_profile(df.limit(0)).first().pct is None


def test_profile_is_one_scan(flawed, tmp_path, spark):
    flawed.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for report in (quality.null_profile(df), quality.outlier_report(df), quality.zero_audit(df)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_duplicates(flawed):
    stamped = flawed.withColumn("ingest_ts", F.current_timestamp())
    assert quality.duplicate_count(stamped).first().asDict() == {"rows": 7, "distinct_rows": 6, "duplicate_rows": 1}
    assert quality.duplicate_count(flawed.limit(0)).first().asDict() == {"rows": 0, "distinct_rows": 0, "duplicate_rows": 0}


def test_outliers_first_and_any(flawed):
    found = rows(quality.outlier_report(flawed), "column")
    # negative steps are clipped to 0, which the rule allows; null breaks a rule
    assert {c: (r.removed, r.violations) for (c,), r in found.items() if r.violations} == {
        "age": (2, 2),
        "steps": (0, 1),
        "sleep_hours": (2, 2),
        "bmi": (0, 1),
    }
    assert quality.outlier_rate(flawed).first().asDict() == {"rows": 7, "outliers": 4, "pct": 57.14}
    unclipped = rows(quality.outlier_report(flawed, clip=()), "column")
    assert unclipped["steps",].violations == 2 and unclipped["exercise_minutes",].removed == 1


def test_zero_audit(flawed):
    found = rows(quality.zero_audit(flawed), "column")
    assert (found["steps",].zeros, found["sleep_hours",].zeros) == (1, 1)


def test_completeness(flawed):
    kept = flawed.filter("steps > 0")
    assert quality.completeness(flawed, kept).first().asDict() == {"rows_before": 7, "rows_after": 5, "pct_kept": 71.43}
    assert quality.completeness(flawed.limit(0), flawed.limit(0)).first().pct_kept is None


def test_category_distribution(flawed):
    found = rows(quality.category_distribution(flawed, ["gender", "age"]), "column", "category")
    assert {k: r.rows for k, r in found.items()} == {
        ("gender", "M"): 5, ("gender", None): 2, ("age", "30"): 5, ("age", "17"): 1, ("age", None): 1,
    }
    assert found["gender", None].pct == 28.57


def test_quality_issues(flawed):
    found = {k: r.bad_rows for k, r in rows(quality.quality_issues(flawed), "check", "column").items()}
    assert found == {
        ("missing", "age"): 1, ("missing", "gender"): 2, ("missing", "sleep_hours"): 1, ("missing", "date"): 1,
        ("out_of_range", "age"): 1, ("out_of_range", "steps"): 2, ("out_of_range", "sleep_hours"): 1,
        ("out_of_range", "exercise_minutes"): 1, ("out_of_range", "bmi"): 1,
        ("zero", "steps"): 1, ("zero", "sleep_hours"): 1, ("duplicate", "*"): 1,
    }


def test_describe(flawed):
    found = rows(quality.describe_numeric(flawed, ["steps", "sleep_hours"]), "column")
    steps = [8000, 8000, -5, 0, 60000, 8000, 8000]
    r = found["steps",]
    assert (r.n, r.median, r.min, r.max) == (7, 8000.0, -5.0, 60000.0)
    assert r["mean"] == round(statistics.mean(steps), 2) and r.stddev == round(statistics.stdev(steps), 2)
    assert found["sleep_hours",].n == 6
    rough = rows(quality.describe_numeric(flawed, ["steps"], approx=True), "column")
    assert rough["steps",].median == 8000.0
    assert quality.age_distribution(flawed).first().asDict() == {"min": 17.0, "max": 30.0, "mean": 27.83, "median": 30.0}


def columns_to_measure():
    rng = random.Random(5)
    n = 3001
    return {
        "even": [rng.random() for _ in range(n - 1)] + [None],
        "odd": [rng.gauss(0, 1e6) for _ in range(n)],
        "copies": [float(rng.randrange(3)) for _ in range(n)],
        "one_value": [4.0] * n,
        "heavy": [0.0 if rng.random() < 0.4 else rng.expovariate(1e-9) for _ in range(n)],
        "two_middles": [float(i < n // 2) for i in range(n - 1)] + [None],
        "few": [1.0, 2.0] + [None] * (n - 2),
        "empty": [None] * n,
        "integers": [float(i % 997) for i in range(n)],
    }


@pytest.mark.parametrize("max_values", [1, 50, 10**6])
def test_exact_medians(spark, max_values, monkeypatch):
    data = columns_to_measure()
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(4)
    # a coarse sketch, so that brackets are wide and have to be narrowed again
    monkeypatch.setattr(quality, "SKETCH_ACCURACY", 40)
    found = {r.column: r.median for r in quality.exact_medians(df, list(data), max_values).collect()}
    for c, values in data.items():
        known = [v for v in values if v is not None]
        assert found.get(c) == (statistics.median(known) if known else None), c


def test_unconfirmed_bracket_is_not_used(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    monkeypatch.setattr(quality.F, "percentile_approx", lambda *_: F.array(F.lit(90.0), F.lit(95.0)))
    assert quality.exact_medians(df, ["v"], 10).first().median == 50.0


def test_stamp_and_required_rows(flawed):
    at = quality.stamp(flawed, "2024-01-02 03:04:05").select("ingest_ts").distinct().collect()
    assert [r[0] for r in at] == [datetime.datetime(2024, 1, 2, 3, 4, 5)]
    assert quality.stamp(flawed).select("ingest_ts").distinct().count() == 1
    assert quality.require_rows(flawed) is flawed
    with pytest.raises(ValueError, match="no rows"):
        quality.require_rows(flawed.limit(0))


def test_medians_where_no_sketch_holds(spark, monkeypatch, max_values=3):
    """Every bracket of the sketches is refused: ranges must find the middle by themselves."""
    monkeypatch.setattr(quality._Bracket, "holds", lambda *_: False)
    rng = random.Random(3)
    data = {
        "plain": [rng.uniform(-5, 5) for _ in range(301)],
        "even": [float(rng.randint(0, 1000)) for _ in range(300)],
        "copies": [7.0] * 250 + [float(i) for i in range(51)],
        "two": [1.0] * 150 + [2.0] * 150,
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(301)],
        "whole_range": [-1.7e308, 1.7e308] * 150 + [3.0],
        "endless": [float("-inf")] * 100 + [float("inf")] * 120 + [1.0, 2.0, 5.0] * 27,
        "upper": [float("inf")] * 200 + [1.0] * 101,
    }
    n = max(map(len, data.values()))
    rows = list(zip(*[v + [None] * (n - len(v)) for v in data.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(3)
    found = {r["column"]: r["median"] for r in quality.exact_medians(df, list(data), max_values).collect()}
    for c, values in data.items():
        known = [v for v in values if v is not None]
        assert found.get(c) == (statistics.median(known) if known else None), c
    plan = quality.exact_medians(df, ["wide"], max_values)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
