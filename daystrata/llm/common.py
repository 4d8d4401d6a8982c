"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.sources.files import scratch_dir

# Java pattern of a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def keep(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends here, and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a kept table, marked for broadcast if it has at most ``rows`` rows; else unchanged, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def text_of(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keep_in_batches(df: DataFrame, rows: int = 256) -> DataFrame:
    """``keep`` with at most ``rows`` rows in a batch to Python, so that a batch of long texts stays small."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        return keep(df)
    finally:
        spark.conf.set(name, before)
