"""The stages from CSV to star schema, each reading and writing Parquet once."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession

from daystrata.operators.quality import null_counts, require_rows, stamp
from daystrata.operators.star import build_dim_activity, build_dim_date, build_dim_user, build_fact_daily
from daystrata.plans.enrich import build_silver
from daystrata.sources.files import read_daily_csv, read_table, write_table

LOGGER = logging.getLogger(__name__)


def run_bronze(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    multiline: bool | None = None,
    ingest_ts: str | None = None,
) -> DataFrame:
    """CSV -> checked, stamped Parquet. Row and null counts are taken during the write, not by extra scans."""
    raw = read_daily_csv(spark, raw_path, multiline)
    require_rows(raw, f"{raw_path} holds no rows")
    bronze = stamp(raw, ingest_ts)
    seen = Observation()
    observed = bronze.observe(seen, *[agg.alias(name) for name, agg in null_counts(bronze.columns).items()])
    observed.write.mode("overwrite").parquet(str(output_path))
    counts = seen.get
    LOGGER.info("bronze: %s rows", counts["rows"])
    for c in bronze.columns:
        if counts[f"null_{c}"] == counts["rows"]:
            LOGGER.warning("%s: no value in any row", c)
    return read_table(spark, output_path)


def run_silver(
    spark: SparkSession, bronze_path: str, output_path: str, partition_by: tuple[str, ...] = (), **options
) -> DataFrame:
    """Bronze -> cleaned and enriched Parquet; ``options`` go to ``build_silver``."""
    bronze = read_table(spark, bronze_path, "Run the bronze stage first.")
    counts = write_table(build_silver(bronze, **options), output_path, partition_by, counts="rows")
    LOGGER.info("silver: %s rows", counts["rows"])
    return read_table(spark, output_path)


def run_gold(
    spark: SparkSession,
    silver_path: str,
    dim_user_path: str,
    dim_date_path: str,
    dim_activity_path: str,
    fact_daily_path: str,
    sort: bool = True,
    partition_by: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Silver -> dim_user, dim_date, dim_activity, fact_daily; each scans only its own columns.

    ``partition_by`` (such as year, month) applies to the fact.
    """
    silver = read_table(spark, silver_path, "Run the silver stage first.")
    tables = {
        dim_user_path: build_dim_user(silver, sort),
        dim_date_path: build_dim_date(silver, sort),
        dim_activity_path: build_dim_activity(silver, sort),
        fact_daily_path: build_fact_daily(silver),
    }
    for path, table in tables.items():
        counts = write_table(table, path, partition_by if path == fact_daily_path else (), counts="rows")
        LOGGER.info("%s: %s rows", path, counts["rows"])
    return tuple(read_table(spark, path) for path in tables)


def run_predictions(spark: SparkSession, fact_daily_path: str, output_path: str, **options) -> DataFrame:
    """Daily fact -> predictions of three models for every row; ``options`` go to ``train_and_score``."""
    from daystrata.plans.models import train_and_score

    fact = read_table(spark, fact_daily_path, "Run the gold stage first.")
    counts = write_table(train_and_score(fact, **options), output_path, counts="rows")
    LOGGER.info("predictions: %s rows", counts["rows"])
    return read_table(spark, output_path)
