"""Incremental ingest: new CSV files become bronze rows, and the silver rows of their users are rebuilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.operators.quality import stamp
from daystrata.plans.enrich import build_silver
from daystrata.schema import daily_log_schema
from daystrata.sources.files import read_daily_csv, read_table, write_table

BUCKET = "user_bucket"
# Number of the micro-batch that wrote a row.
BATCH = "batch"

# Buckets of users in which bronze and silver are stored; a batch rebuilds whole buckets.
BUCKETS = 256


def user_bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.hash("user_id"), F.lit(buckets))


def csv_stream(spark: SparkSession, raw_dir: str, multiline: bool = True, max_files: int | None = None) -> DataFrame:
    """Daily-log CSV files as they arrive in ``raw_dir``; a file with another header fails the stream."""
    reader = spark.readStream.schema(daily_log_schema()).option("header", True).option("multiLine", multiline)
    reader = reader.option("escape", '"').option("enforceSchema", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(str(raw_dir))


def ingest_new_files(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    multiline: bool = True,
    max_files: int | None = None,
) -> None:
    """Append every file not yet ingested to bronze, exactly once, and stop.

    Bronze is partitioned by user bucket, so that a later refresh reads only the buckets that it needs. Rows are
    rebalanced on the bucket first, so that a batch gives each bucket few files instead of one from every task.
    """
    rows = stamp(csv_stream(spark, raw_dir, multiline, max_files)).withColumn(BUCKET, user_bucket(buckets)).hint("rebalance", BUCKET)
    writer = rows.writeStream.format("parquet").partitionBy(BUCKET).option("checkpointLocation", str(checkpoint))
    writer.trigger(availableNow=True).start(str(bronze_path)).awaitTermination()


def ingest_by_header(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    multiline: bool | None = None,
    max_files: int | None = None,
    counts_path: str | None = None,
) -> None:
    """Append every file not yet ingested to bronze, each bound by the names in its own header, and stop.

    The stream lists new files without reading them; each micro-batch then reads its files as ``read_daily_csv`` does,
    in one parse per order of columns, and writes them to partitions of its own, so a batch that fails is written
    again in the same place. A file with absent, unknown or repeated names stops the stream before anything of its
    batch is written. ``max_files`` bounds a batch, and what the driver sees of it: its file names.
    With ``counts_path`` the number of rows of each batch is kept as a table there.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files is not None:
        files = files.option("maxFilesPerTrigger", max_files)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        names = sorted(row[0] for row in batch.collect())
        if not names:
            return
        rows = stamp(read_daily_csv(batch.sparkSession, names, multiline))
        rows = rows.withColumns({BUCKET: user_bucket(buckets), BATCH: F.lit(batch_id).cast("long")})
        counted = write_table(rows, bronze_path, (BUCKET, BATCH), dynamic=True, counts="rows")
        if counts_path is not None:
            write_counts(batch.sparkSession, counts_path, batch_id, counted["rows"])

    listed = files.load(str(raw_dir)).select("path")
    writer = listed.writeStream.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True)
    writer.foreachBatch(ingest).start().awaitTermination()


def write_counts(spark: SparkSession, path: str, batch_id: int, rows: int) -> None:
    """Keep the number of rows that a batch wrote; writing it again replaces it."""
    row = spark.createDataFrame([(rows, batch_id)], f"rows long, {BATCH} long")
    write_table(row, path, (BATCH,), dynamic=True)


def refresh_buckets(batch: DataFrame, bronze_path: str, silver_path: str, **options) -> None:
    """Rebuild silver for the buckets that ``batch`` touches.

    Bronze is pruned to those buckets and exactly their silver partitions are replaced, so running a batch again
    changes nothing. The driver sees bucket numbers only, of which there is a fixed number.
    """
    spark = batch.sparkSession
    touched = sorted(row[0] for row in batch.select(BUCKET).distinct().collect())
    if not touched:
        return
    bronze = read_table(spark, bronze_path, "Run the ingest first.").filter(F.col(BUCKET).isin(touched))
    write_table(build_silver(bronze, **options), silver_path, (BUCKET,), dynamic=True)


def refresh_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    max_files: int | None = None,
    **options,
) -> None:
    """Bring silver up to date with all bronze files not yet seen, and stop."""
    schema = read_table(spark, bronze_path, "Run the ingest first.").schema
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(str(bronze_path)).select(BUCKET)
    writer = stream.writeStream.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True)
    query = writer.foreachBatch(lambda batch, _: refresh_buckets(batch, bronze_path, silver_path, **options)).start()
    query.awaitTermination()
