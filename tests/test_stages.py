from __future__ import annotations

import datetime
import logging

import pytest
from pyspark.sql import functions as F

from daystrata.catalog.queries import fact_frame
from daystrata.plans import models, stages
from daystrata.plans.enrich import build_silver
from daystrata.schema import DAILY_LOG_FIELDS


def test_bronze(spark, tmp_path, write_csv_rows, caplog):
    path = write_csv_rows(
        tmp_path / "raw.csv",
        {"user_id": 1, "age": 25, "steps": 10000, "bmi": None},
        {"user_id": 2, "age": 30, "gender": "F", "date": "2024-09-07", "bmi": None},
    )
    out = str(tmp_path / "bronze.parquet")
    with caplog.at_level(logging.INFO):
        df = stages.run_bronze(spark, path, out)
    assert (tmp_path / "bronze.parquet").exists()
    assert df.columns == [*DAILY_LOG_FIELDS, "ingest_ts"] and df.count() == 2
    assert "bronze: 2 rows" in caplog.text and "bmi: no value in any row" in caplog.text
    first, again = (df.agg(F.max("ingest_ts")).first()[0] for _ in range(2))
    assert first == again
    fixed = stages.run_bronze(spark, path, out, ingest_ts="2024-01-01 00:00:00")
    assert fixed.select("ingest_ts").distinct().first()[0] == datetime.datetime(2024, 1, 1)


def test_bronze_refuses_missing_and_empty_input(spark, tmp_path, write_csv_rows):
    out = tmp_path / "out"
    with pytest.raises(FileNotFoundError):
        stages.run_bronze(spark, "/nonexistent.csv", str(out))
    with pytest.raises(ValueError, match="no rows"):
        stages.run_bronze(spark, write_csv_rows(tmp_path / "raw.csv"), str(out))
    assert not out.exists()


@pytest.mark.parametrize(
    "run, stage",
    [
        (lambda s, p: stages.run_silver(s, p, p), "bronze"),
        (lambda s, p: stages.run_gold(s, p, p, p, p, p), "silver"),
        (lambda s, p: stages.run_predictions(s, p, p), "gold"),
    ],
)
def test_stages_name_the_stage_to_run_first(spark, tmp_path, run, stage):
    with pytest.raises(FileNotFoundError, match=f"Run the {stage} stage first"):
        run(spark, str(tmp_path / "nothing"))


def test_silver_cleans_and_enriches(spark, tmp_path, write_csv_rows):
    path = write_csv_rows(
        tmp_path / "raw.csv",
        {"user_id": 1, "steps": 10000},
        {"user_id": 1, "date": "2024-09-07", "steps": 50000, "weight_kg": 81.5},
        {"user_id": 2, "steps": 0, "sleep_hours": 5.0},
    )
    stages.run_bronze(spark, path, str(tmp_path / "bronze"))
    df = stages.run_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    assert len(df.columns) == 39
    first, second = df.orderBy("date").collect()
    assert (first.activity_level, second.activity_level, first.sleep_quality) == ("moderate", "active", "fair")
    assert (first.weight_prev, second.weight_prev, second.ra30_steps) == (None, 81.0, 30000.0)
    assert df.filter("steps = 0").isEmpty()


def month_of_rows(user, days=40):
    first = datetime.date(2024, 9, 6)
    return [
        {
            "user_id": user, "date": str(first + datetime.timedelta(days=d)), "stress_level": 1 + (d * user) % 10,
            "weight_kg": 70.0 + d, "steps": 1000 * (1 + d % 20), "gender": "MF"[user % 2], "sleep_hours": 5.0 + d % 6,
        }
        for d in range(days)
    ]


def test_changes_over_thirty_rows(make_log):
    silver = build_silver(make_log(*month_of_rows(1)))
    changed = silver.orderBy("date").collect()
    assert [r.weight_change_30d for r in changed] == [None] * 30 + [30.0] * 10
    assert [r.stress_change_30d for r in changed] == [None] * 30 + [0] * 10
    held = build_silver(make_log(*month_of_rows(1)), clamp=5).orderBy("date").collect()
    assert [r.weight_change_30d for r in held] == [None] * 30 + [5.0] * 10
    by_day = build_silver(make_log(*month_of_rows(1)), frame="days").orderBy("date").collect()
    assert [r.weight_change_30d for r in by_day] == [None] * 30 + [30.0] * 10


def test_split_users_give_the_same_silver(make_log):
    log = make_log(*month_of_rows(1), *month_of_rows(2, 12), *month_of_rows(1, 7), *month_of_rows(3, 3))
    stamped = log.withColumn("ingest_ts", F.lit("2024-01-01").cast("timestamp"))
    plain = build_silver(stamped)
    assert plain.count() == 55
    for options in ({"group_rows": 5}, {"group_rows": 40}, {"group_rows": 5, "frame": "days"}):
        expected = plain if "frame" not in options else build_silver(stamped, frame="days")
        split = build_silver(stamped, **options)
        assert split.columns == expected.columns
        assert split.exceptAll(expected).isEmpty() and expected.exceptAll(split).isEmpty()


def shuffles(plan):
    return plan.count("Exchange hashpartitioning")


def test_silver_takes_one_shuffle_and_one_sort(spark, make_log, tmp_path):
    make_log(*month_of_rows(1)).write.parquet(str(tmp_path / "bronze"))
    plan = build_silver(spark.read.parquet(str(tmp_path / "bronze")))._jdf.queryExecution().executedPlan().toString()
    assert shuffles(plan) == 1 and plan.count("Sort [") == 1
    assert plan.count("FileScan") == 1
    for name in ("GreaterThanOrEqual(bmi,10.0)", "LessThanOrEqual(steps,50000)", "IsNotNull(user_id)"):
        assert name in plan


def test_gold_scans_only_what_it_needs(spark, make_log, tmp_path):
    build_silver(make_log(*month_of_rows(1))).write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    plan = stages.build_dim_user(silver)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "user_id" in read and "bmr" in read and "steps" not in read
    assert "struct<date:date>" in stages.build_dim_date(silver)._jdf.queryExecution().executedPlan().toString()
    assert shuffles(stages.build_fact_daily(silver)._jdf.queryExecution().executedPlan().toString()) == 0


@pytest.fixture(scope="module")
def fact_path(spark, tmp_path_factory, make_log):
    folder = tmp_path_factory.mktemp("gold")
    log = make_log(*[row for user in (1, 2, 3) for row in month_of_rows(user)])
    log.withColumn("ingest_ts", F.current_timestamp()).write.parquet(f"{folder}/bronze")
    stages.run_silver(spark, f"{folder}/bronze", f"{folder}/silver", partition_by=("year", "month"))
    tables = stages.run_gold(
        spark, f"{folder}/silver", f"{folder}/user", f"{folder}/date", f"{folder}/activity", f"{folder}/fact",
        partition_by=("year", "month"),
    )
    assert [t.count() for t in tables] == [3, 40, 120, 120]
    assert "activity_level" in tables[2].columns
    assert (folder / "fact" / "year=2024" / "month=9").exists()
    return f"{folder}/fact"


def test_predictions(spark, fact_path, tmp_path):
    out = tmp_path / "predictions"
    df = stages.run_predictions(spark, fact_path, str(out))
    assert out.exists() and df.count() == 120
    assert df.columns == [
        "user_id", "date_key", "predicted_stress_change", "actual_stress_change", "predicted_sleep_quality",
        "actual_sleep_quality", "predicted_weight_change_30d", "actual_weight_change_30d",
    ]
    assert df.filter(" or ".join(f"{c} is null" for c in df.columns)).isEmpty()
    actual = df.filter("user_id = 1").orderBy("date_key").collect()
    assert [r.actual_weight_change_30d for r in actual] == [0.0] * 30 + [30.0] * 10


def test_models_repeat_and_learn(spark, fact_path):
    small = tuple(models.Target(**{**t.__dict__, "trees": 3, "depth": 3}) for t in models.TARGETS)
    fact = spark.read.parquet(fact_path)
    rows = models._with_split(models.with_targets(models.prepare_ml(fact)), 0.8, 42, None)
    trained = models.train_models(rows, small)
    assert set(trained.metrics) == {"stress", "sleep", "weight"}
    assert 0 <= trained.metrics["sleep"]["accuracy"] <= 1 and trained.metrics["weight"]["rmse"] >= 0
    scored = models.score(rows, trained, small, with_split=True)
    assert {r[0] for r in scored.select("split").distinct().collect()} == {"train", "test"}
    assert shuffles(scored._jdf.queryExecution().executedPlan().toString()) == 0
    for layout in (2, 7):
        dealt = rows.repartition(layout)
        again = models.score(dealt, models.train_models(dealt, small, parallelism=1), small, with_split=True)
        assert scored.exceptAll(again).isEmpty()


def test_models_beat_a_trivial_one_on_rows_not_seen(spark):
    steps, stress = F.col("steps"), F.col("stress_level")
    fact = fact_frame(spark, "/root/testdata/sf0.001").withColumns(
        {
            "stress_change_30d": F.when(steps > 12_000, 3).when(steps < 9_000, -3).otherwise(0),
            "sleep_quality": F.when(stress > 6, "poor").when(stress > 3, "fair").otherwise("good"),
            "weight_change_30d": steps / 5_000 + F.col("age") / 20,
        }
    )
    few = tuple(models.Target(**{**t.__dict__, "trees": 8}) for t in models.TARGETS)
    rows = models._with_split(models.with_targets(models.prepare_ml(fact)), 0.8, 42, None)
    metrics = models.train_models(rows, few).metrics
    test = rows.filter("split = 'test'")
    for target in few:
        if target.classes:
            most = test.groupBy(target.label).count().agg(F.max("count")).first()[0]
            assert metrics[target.name]["accuracy"] > most / test.count()
        else:
            assert metrics[target.name]["rmse"] < test.agg(F.stddev_pop(target.label)).first()[0]


def test_the_bound_on_rows_is_for_classifiers_only(spark, fact_path):
    rows = models._with_split(models.with_targets(models.prepare_ml(spark.read.parquet(fact_path))), 0.8, 42, None)
    weight = (models.Target(**{**models.TARGETS[2].__dict__, "trees": 3, "depth": 3}),)
    bounded, whole = (models.score(rows, models.train_models(rows, weight, fit_rows=n), weight) for n in (10, 10**9))
    assert bounded.exceptAll(whole).isEmpty()
    stress = (models.Target(**{**models.TARGETS[0].__dict__, "trees": 3, "depth": 3}),)
    assert models._fitting_rows(rows, 10).filter("_fit").count() < rows.filter("split = 'train'").count() / 2
    assert models.score(rows, models.train_models(rows, stress, fit_rows=60, fit_partitions=3), stress).count() == rows.count()


def test_forests_take_all_train_rows(spark, fact_path, monkeypatch):
    """Unless a caller asks for it there is no bound, however many rows there are."""
    rows = models._with_split(models.with_targets(models.prepare_ml(spark.read.parquet(fact_path))), 0.8, 42, None)
    bounds, marked = [], models._fitting_rows
    monkeypatch.setattr(models, "_fitting_rows", lambda df, n: bounds.append(n) or marked(df, n))
    stress = (models.Target(**{**models.TARGETS[0].__dict__, "trees": 2, "depth": 2}),)
    models.train_models(rows, stress)
    models.train_and_score(spark.read.parquet(fact_path), targets=stress)
    assert bounds == [None, None]
    assert marked(rows).filter("_fit is distinct from (split = 'train')").isEmpty()


def test_forests_train_together_as_far_as_their_rows_fit(spark, fact_path, monkeypatch):
    small = tuple(models.Target(**{**t.__dict__, "trees": 2, "depth": 2}) for t in models.TARGETS)
    rows = models._with_split(models.with_targets(models.prepare_ml(spark.read.parquet(fact_path))), 0.8, 42, None)
    assert models.storage_bytes(spark) > 2**20
    sizes, pool = [], models.ThreadPool
    monkeypatch.setattr(models, "ThreadPool", lambda n: sizes.append(n) or pool(n))
    scored = []
    for room in (2**40, 1):
        monkeypatch.setattr(models, "storage_bytes", lambda _, room=room: room)
        scored.append(models.score(rows, models.train_models(rows, small), small, with_split=True))
    assert sizes == [3, 2]
    assert scored[0].exceptAll(scored[1]).isEmpty() and scored[1].exceptAll(scored[0]).isEmpty()


@pytest.mark.parametrize(
    "train_rows, fit_rows, room, parallelism, expected",
    [
        # Bytes a row: 476 for stress, 404 for sleep, 448 for weight.
        (1000, 1000, 1_328_000, 3, 3),
        (1000, 1000, 1_327_999, 3, 2),
        (1000, 10, 456_800, 3, 3),
        (1000, 10, 1, 1, 1),
        (0, 0, 0, 3, 3),
    ],
)
def test_forests_at_a_time(train_rows, fit_rows, room, parallelism, expected):
    assert models.at_a_time(models.TARGETS, train_rows, fit_rows, room, parallelism) == expected
    assert models.at_a_time(models.TARGETS[:1], train_rows, fit_rows, room, parallelism) == 1


def test_many_categories_train(spark, make_log):
    """Dirty categories share one bucket, so there are never too many of them for a tree."""
    rows = [r | {"gender": f"g{i}"} for i, r in enumerate(month_of_rows(1, 80))] + list(month_of_rows(2, 5))
    fact = stages.build_fact_daily(build_silver(make_log(*rows)))
    few = (models.Target(**{**models.TARGETS[2].__dict__, "trees": 2, "depth": 2}),)
    assert models.train_and_score(fact, targets=few, fit_rows=40).count() == 85
    kept = models.known_categories(fact.select("gender", "activity_level"))
    assert {r.gender for r in kept.select("gender").collect()} == {None, "M"}


def test_upstream_runs_once(spark, fact_path):
    """Training and scoring read the stored model frame, not what it was made from."""
    fact = spark.read.parquet(fact_path)
    few = (models.Target(**{**models.TARGETS[2].__dict__, "trees": 2, "depth": 2}),)
    plan = models.train_and_score(fact, targets=few)._jdf.queryExecution().executedPlan().toString()
    assert fact_path not in plan


def test_model_frame(spark, fact_path):
    fact = spark.read.parquet(fact_path)
    frame = models.prepare_ml(fact)
    assert frame.columns == list(models.MODEL_COLUMNS) and frame.count() == 120
    assert frame.filter(" or ".join(f"{c} is null" for c in models.ZERO_FILLED)).isEmpty()
    assert models.prepare_ml(fact, drop_no_history=True).count() == 30
    by_day = models.train_and_score(fact, first_test_key=20241010, with_split=True, targets=models.TARGETS[2:])
    assert by_day.filter("split = 'test'").select("date_key").distinct().count() == 6


def test_one_class_trains(spark, make_log):
    rows = [r | {"sleep_hours": 7.0, "stress_level": 5} for r in month_of_rows(1, 10)]
    small = tuple(models.Target(**{**t.__dict__, "trees": 2, "depth": 2}) for t in models.TARGETS[:2])
    fact = stages.build_fact_daily(build_silver(make_log(*rows)))
    scored = models.train_and_score(fact, targets=small)
    assert {(r.predicted_sleep_quality, r.predicted_stress_change) for r in scored.collect()} == {("fair", "no_changes")}
