from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

from daystrata.operators import evaluate


def test_split_does_not_depend_on_the_layout(spark):
    df = spark.range(5000).selectExpr("cast(id as int) user_id", "20240101 date_key")
    one = evaluate.hash_split(df.repartition(2)).select("user_id", "split")
    other = evaluate.hash_split(df.repartition(7, "user_id")).select("user_id", "split")
    assert one.exceptAll(other).isEmpty()
    train = one.filter("split = 'train'").count()
    assert 3800 < train < 4200
    assert evaluate.hash_split(df, seed=43).select("user_id", "split").exceptAll(one).count() > 500
    assert evaluate.hash_split(df, train=1.0).filter("split = 'test'").isEmpty()


@pytest.mark.parametrize("share", [0.995, 0.004])
def test_shares_are_not_rounded(spark, share):
    df = spark.range(20_000).selectExpr("cast(id as int) user_id", "20240101 date_key")
    train = evaluate.hash_split(df, train=share).filter("split = 'train'").count()
    assert abs(train - share * 20_000) < 40


def test_split_takes_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "user_id int, date_key int")
    assert {r.split for r in evaluate.hash_split(df).collect()} <= {"train", "test"}


def test_date_split(spark):
    df = spark.createDataFrame([(20240101,), (20240102,)], "date_key int")
    assert [r.split for r in evaluate.date_split(df, 20240102).orderBy("date_key").collect()] == ["train", "test"]


def test_classification_metrics_agree_with_spark(spark):
    rng = random.Random(1)
    rows = [(float(rng.choice([0, 0, 0, 1, 2])), float(rng.choice([0, 1, 3]))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = evaluate.classification_metrics(df, "label", "prediction").first()
    for name in ("accuracy", "f1"):
        assert found[name] == pytest.approx(MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(df))
    assert found.rows == 500
    assert evaluate.classification_metrics(df.limit(0), "label", "prediction").first().accuracy is None


def test_regression_metrics_agree_with_spark(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.random(), rng.random()) for _ in range(200)], "label double, prediction double")
    found = evaluate.regression_metrics(df, "label", "prediction").first()
    for name in ("rmse", "mae"):
        assert found[name] == pytest.approx(RegressionEvaluator(labelCol="label", metricName=name).evaluate(df))
