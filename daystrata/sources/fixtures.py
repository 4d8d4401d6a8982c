"""Daily-log frames derived from the line items of an order table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier ("user") and ship date, with metrics derived from the items shipped that day."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = F.col("l_shipdate").cast("date")
    sums = items.groupBy("l_suppkey", day.alias("date")).agg(
        F.sum(F.col("l_quantity").cast("int")).alias("q"),
        F.sum("l_orderkey").alias("o"),
        F.sum("l_partkey").alias("p"),
    )
    user, q, o, p = (F.col(c) for c in ("l_suppkey", "q", "o", "p"))
    return sums.select(
        user.cast("int").alias("user_id"),
        (18 + user % 60).cast("int").alias("age"),
        F.when(user % 3 == 0, "M").when(user % 3 == 1, "F").alias("gender"),
        "date",
        (400 * q - 2000).cast("int").alias("steps"),
        (25 + o % 190).cast("double").alias("heart_rate_avg"),
        (1.5 + (p % 30) * 0.5).alias("sleep_hours"),
        (400 + (o * 7) % 8000).cast("double").alias("calories_burned"),
        ((p * 3) % 640 - 20).cast("double").alias("exercise_minutes"),
        ((o + p) % 11).cast("int").alias("stress_level"),
        (40 + user % 80 + (o % 8) * 0.5).alias("weight_kg"),
        (16 + user % 20 + (p % 4) * 0.25).alias("bmi"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``daily_log`` with text dates and defects: missing users, bad dates, missing and zero sleep, copies."""
    log = daily_log(spark, sf_dir)
    steps, calories = F.col("steps"), F.col("calories_burned")
    flawed = log.withColumns(
        {
            "user_id": F.when(~((F.col("stress_level") == 3) & (steps % 3 == 0)), F.col("user_id")),
            "date": F.when(steps % 7 == 0, "2024-9-6")
            .when(steps % 11 == 0, "garbage")
            .otherwise(F.col("date").cast("string")),
            "sleep_hours": F.when(calories % 11 == 0, None)
            .when(calories % 13 == 0, F.lit(0.0))
            .otherwise(F.col("sleep_hours")),
        }
    )
    copies = F.when(F.col("user_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return flawed.withColumn("_copy", F.explode(copies)).drop("_copy")
