"""Exact duplicates by a stream of digests into disk-backed keyed state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.llm.common import keep, small, text_of
from daystrata.sources.files import scratch_dir

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Disk that is reserved ahead is some megabytes a state partition, however little it holds.
FALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
# Digests that are broadcast when texts are compared; more of them are joined by shuffle.
BROADCAST_DIGESTS = 200_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def fold_digests(spark: SparkSession, digests: str, checkpoint: str) -> DataFrame:
    """Stream the files of ``digests`` into the state kept in ``checkpoint``, and read the state.

    State is keyed by digest and never expires. For each digest it has the stable identifier (the largest id), the
    locator of that row's content and the number of rows. Calling again with the same checkpoint adds new files only.
    """
    schema = spark.read.parquet(digests).schema
    folded = (
        spark.readStream.schema(schema)
        .parquet(digests)
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.max_by("locator", "id").alias("locator"), F.count("*").alias("n"))
    )
    settings = {PROVIDER: ROCKSDB, FALLOCATE: "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        query = (
            folded.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    # The value holds what the aggregates keep, in their order: max, max_by as (value, order), count.
    keep_id, locator, _, n = state.schema["value"].dataType.names
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value")[keep_id].alias("keep_id"),
        F.col("value")[locator].alias("locator"),
        F.col("value")[n].alias("n"),
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    broadcast_digests: int = BROADCAST_DIGESTS,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, locator.

    Rows whose texts are equal byte for byte form a group; the largest id stays. Only digests, ids and locators are
    streamed and shuffled. Where a digest was hit again, the full texts of its rows are compared: per digest the
    smallest and the largest text must be the same, which Spark finds with partial aggregates, so a group may hold
    any share of the rows. Digests whose texts differ are grouped anew by the texts themselves.

    Null texts count as empty ones, and empty texts are equal to each other. A null id loses to any other; in a group
    that has null ids only, keep_id is null. Rows repeated with their id count once each in group_size and share the
    same answer (``kept`` is true for all rows with the id that stays). An empty table gives an empty result; columns
    other than id and text are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    path = scratch_dir(spark)
    rows.select(
        "id",
        digest(F.col("text")).alias("digest"),
        F.sha2("text", 256).alias("sha256"),
        F.concat_ws(":", F.input_file_name(), F.input_file_block_start()).alias("locator"),
    ).write.parquet(path)
    staged = spark.read.parquet(path)
    if staged.isEmpty():
        return _shaped(staged.withColumns({"keep_id": F.col("id"), "n": F.lit(0).cast("long")}))
    state = keep(fold_digests(spark, path, scratch_dir(spark)))
    repeated = small(keep(state.filter("n > 1").select("digest")), broadcast_digests)
    hit = rows.withColumn("digest", digest(F.col("text"))).join(repeated, "digest")
    texts = hit.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))
    differing = keep(texts.filter("least <> most").select("digest"))
    answers = staged.drop("locator").join(state, "digest")
    if not differing.isEmpty():
        answers = answers.join(differing, "digest", "left_anti").unionByName(
            _by_text(rows.withColumn("digest", digest(F.col("text"))), differing)
        )
    return _shaped(answers)


def _by_text(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """Answers for rows whose digest stands for several texts: equal texts are found by the texts, without locators."""
    hit = rows.join(differing, "digest", "left_semi")
    texts = hit.groupBy("text").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))
    return hit.join(texts, "text").select(
        "digest", "id", F.sha2("text", 256).alias("sha256"), "keep_id", F.lit(None).cast("string").alias("locator"), "n"
    )


def _shaped(answers: DataFrame) -> DataFrame:
    return answers.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
        "locator",
    )
