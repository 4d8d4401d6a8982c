"""Gold by difference: each batch of silver adds its sums and counts and takes back those of the rows it supersedes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.functions.scalar import date_key, weekday_name
from daystrata.operators.star import build_fact_daily
from daystrata.sources.files import read_table, write_table
from daystrata.streaming.keyed import BATCH, current_silver, superseded_rows

USER_KEYS = ("user_id", "age", "gender")
MEASURES = ("height_cm", "weight_kg", "bmi", "bmr")
# Sums are kept as decimals: they come out the same in any order, and what is taken back leaves no trace.
SUM_TYPE = "decimal(28,12)"


def _signed(rows: DataFrame, sign: int, keys: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    sums = [(F.col(m).cast(SUM_TYPE) * sign).alias(f"sum_{m}") for m in measures]
    counts = [(F.col(m).isNotNull().cast("long") * sign).alias(f"n_{m}") for m in measures]
    return rows.select(*keys, F.lit(sign).cast("long").alias("n_rows"), *sums, *counts)


def _added_up(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sums of all other columns per key; partial sums of partial sums are the sums of the whole."""
    total = lambda c: F.sum(c).cast("decimal(38,12)") if c.startswith("sum_") else F.sum(c)
    return rows.groupBy(*keys).agg(*[total(c).alias(c) for c in rows.columns if c not in keys])


def apply_batch(spark: SparkSession, silver_path: str, gold_path: str, batch_id: int) -> None:
    """Add what one batch of silver changes: differences per user and per day.

    Each batch has a partition of its own in both tables of differences, so running it again changes nothing. Only the
    batch's rows and those it supersedes are read.
    """
    new = read_table(spark, silver_path, "Run the refresh first.").filter(F.col(BATCH) == batch_id)
    gone = superseded_rows(spark, silver_path, batch_id)
    for name, keys, measures in (("users", USER_KEYS, MEASURES), ("days", ("date",), ())):
        changes = _signed(new, 1, keys, measures)
        if gone is not None:
            changes = changes.unionByName(_signed(gone, -1, keys, measures))
        sums = _added_up(changes, keys).withColumn(BATCH, F.lit(batch_id).cast("long"))
        write_table(sums, f"{gold_path}/{name}", (BATCH,), dynamic=True)


def compact(spark: SparkSession, gold_path: str) -> None:
    """Replace the differences of all batches by their sums, under the newest batch's number.

    No batch may be applied meanwhile. The sums are complete in a folder beside the table before it is overwritten.
    """
    for name, keys in (("users", USER_KEYS), ("days", ("date",))):
        path = f"{gold_path}/{name}"
        rows = read_table(spark, path)
        newest = rows.agg(F.max(BATCH)).first()[0]
        sums = _added_up(rows.drop(BATCH), keys).filter("n_rows <> 0")
        fresh = f"{path}-compact"
        write_table(sums.withColumn(BATCH, F.lit(newest).cast("long")), fresh, (BATCH,))
        write_table(read_table(spark, fresh), path, (BATCH,))


def _mean(measure: str) -> Column:
    return (F.col(f"sum_{measure}").cast("double") / F.col(f"n_{measure}").cast("double")).alias(f"mean_{measure}")


def user_means(spark: SparkSession, gold_path: str) -> DataFrame:
    """Unrounded means per (user_id, age, gender), from the differences of all batches."""
    users = _added_up(read_table(spark, f"{gold_path}/users", "Apply a batch first.").drop(BATCH), USER_KEYS)
    return users.filter("n_rows > 0").select(*USER_KEYS, *map(_mean, MEASURES))


def dim_user(spark: SparkSession, gold_path: str) -> DataFrame:
    means = user_means(spark, gold_path)
    return means.select(*USER_KEYS, *[F.round(f"mean_{m}", 2).alias(f"avg_{m}") for m in MEASURES])


def dim_date(spark: SparkSession, gold_path: str) -> DataFrame:
    days = _added_up(read_table(spark, f"{gold_path}/days", "Apply a batch first.").drop(BATCH), ("date",)).filter("n_rows > 0")
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        weekday_name("date").alias("weekday"),
    )


def fact_daily(spark: SparkSession, silver_path: str) -> DataFrame:
    """The daily fact: a narrow projection of the silver rows that count, so it needs no table of its own."""
    return build_fact_daily(current_silver(spark, silver_path))


def full_user_sums(silver: DataFrame) -> DataFrame:
    """The sums that all batches together must give, from silver as a whole."""
    return _added_up(_signed(silver, 1, USER_KEYS, MEASURES), USER_KEYS)

