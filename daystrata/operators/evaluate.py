"""Train/test splits that do not depend on the layout of the data, and model metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_point(keys: Sequence[str], seed: int = 42) -> Column:
    """Place of a row in 0 to 2**32 - 1 from the MD5 of its keys, the same in any engine and under any partitioning."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_split(
    df: DataFrame, keys: Sequence[str] = ("user_id", "date_key"), train: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``split`` = "train" or "test" by hash of the keys, to one part in 2**32."""
    cut = round(train * 2**32)
    return df.withColumn("split", F.when(split_point(keys, seed) < F.lit(cut), "train").otherwise("test"))


def date_split(df: DataFrame, first_test_key: int, col: str = "date_key") -> DataFrame:
    """Add ``split``: everything from ``first_test_key`` on is "test"."""
    return df.withColumn("split", F.when(F.col(col) < first_test_key, "train").otherwise("test"))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(rows, accuracy, f1); f1 is the mean of the per-class scores weighted by the rows of each class."""
    known = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    pairs = known.groupBy(F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("_l").alias("_class"), F.col("_n").alias("_true"), zero.alias("_called"), hit.alias("_hit")),
        F.struct(F.col("_p").alias("_class"), zero.alias("_true"), F.col("_n").alias("_called"), zero.alias("_hit")),
    )
    classes = pairs.select(F.inline(sides)).groupBy("_class").agg(
        *[F.sum(c).alias(c) for c in ("_true", "_called", "_hit")]
    )
    score = 2 * F.col("_hit") / (F.col("_true") + F.col("_called"))
    rows = F.sum("_true")
    return classes.agg(
        F.coalesce(rows, zero).alias("rows"),
        (F.sum("_hit") / rows).alias("accuracy"),
        (F.sum(F.col("_true") * score) / rows).alias("f1"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(rows, rmse, mae) in one aggregate."""
    error = F.col(prediction) - F.col(label)
    return df.agg(
        F.count(error).alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )
