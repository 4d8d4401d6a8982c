"""One query per operator, each over the whole daily log derived from the line items."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.functions import scalar
from daystrata.operators import clean, evaluate, history, quality, star
from daystrata.plans import models
from daystrata.plans.enrich import build_silver
from daystrata.plans.stages import run_bronze
from daystrata.schema import (
    ACTIVITY_BINS,
    ACTIVITY_FLAGS,
    BMI_BINS,
    INGEST_TS,
    SLEEP_BINS,
)
from daystrata.sources import files
from daystrata.sources.fixtures import daily_log, raw_log
from daystrata.streaming import gold, incremental, keyed

Query = Callable[[SparkSession, str], DataFrame]

DESCRIBED = ("age", "steps", "heart_rate_avg", "sleep_hours", "calories_burned", "exercise_minutes", "stress_level", "weight_kg", "bmi")
STEP_BINS = ((0, "very_low"), (3000, "low"), (7000, "moderate"), (12000, "high"))

MEANS = {
    "ra30_steps": "steps",
    "ra30_calories": "calories_burned",
    "ra30_ex_minutes": "exercise_minutes",
    "ra30_stress": "stress_level",
}

# Labels of the change in stress.
STRESS_LABELS = ("more_stress", "less_stress", "no_changes")

# First day of the test part in the split by date.
FIRST_TEST_KEY = 19980101


def clean_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily log after clipping, range rules and the removal of days without steps."""
    return clean.clean_rows(daily_log(spark, sf_dir))


def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(raw_log(spark, sf_dir))


def fact_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_fact_daily(silver_frame(spark, sf_dir))


def _rounded(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _on(frame: Query, step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(frame(spark, sf_dir))


def _added(frame: Query, step: Callable[[DataFrame], DataFrame], *cols: str, digits: int | None = None) -> Query:
    """Query that shows the key and only the columns a step is about, so that the others are pruned."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shown = step(frame(spark, sf_dir)).select("user_id", "date", *cols)
        return shown if digits is None else _rounded(shown, cols, digits)

    return run


def _completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = daily_log(spark, sf_dir)
    return quality.completeness(log, clean.clean_rows(log))


def _shown(df: DataFrame) -> DataFrame:
    """Silver columns with the irrational ones rounded."""
    means = ["ra30_steps", "ra30_calories", "ra30_ex_minutes", "ra30_stress"]
    return _rounded(df, [*means, "height_cm", "bmr", "caloric_balance"]).withColumn("height_m", F.round("height_m", 4))


def _yesterday_as_prediction(df: DataFrame) -> DataFrame:
    """Deterministic stand-in for a model: the label of the day is guessed from the sleep of the day before."""
    guess = scalar.bin_label("yesterday_sleep", SLEEP_BINS, default="poor")
    rows = df.select("sleep_quality", guess.alias("predicted"))
    return _rounded(evaluate.classification_metrics(rows, "sleep_quality", "predicted"), ["accuracy", "f1"], 4)


def _no_change_as_prediction(df: DataFrame) -> DataFrame:
    rows = df.select("weight_change_30d", F.lit(0.0).alias("predicted"))
    return _rounded(evaluate.regression_metrics(rows, "weight_change_30d", "predicted"), ["rmse", "mae"], 4)


def _merge(df: DataFrame, keys: Sequence[str] = ("user_id", "date_key"), group_rows: int | None = None) -> DataFrame:
    """Three partial projections of the fact, put together again by key; the fact is made once for all of them."""
    df = files.stored(df.select(*keys, "stress_level", "sleep_hours", "sleep_quality", "weight_change_30d"))
    return star.merge_outer(
        df.filter(F.col("stress_level") >= 4).select(*keys, "stress_level"),
        df.filter(F.col("sleep_hours") >= 8).select(*keys, "sleep_quality"),
        df.filter(F.col("weight_change_30d").isNotNull()).select(*keys, "weight_change_30d"),
        on=keys,
        group_rows=group_rows,
    )


def _label_index(df: DataFrame) -> DataFrame:
    """Index of every stress label, turned back into its name."""
    labeled = files.stored(models.with_targets(models.prepare_ml(df)).select("stress_change_label"))
    model = models.label_indexer("stress_change_label", "label_idx").fit(labeled)
    named = models.label_names("label_idx", "label", model.labels).transform(model.transform(labeled))
    return named.groupBy("stress_change_label", "label", "label_idx").agg(F.count(F.lit(1)).alias("rows"))


def _category_index(df: DataFrame) -> DataFrame:
    df = files.stored(models.known_categories(df).select(*models.CATEGORIES))
    indexed = models.category_indexers().fit(df).transform(df)
    return indexed.groupBy("gender", "gender_idx", "activity_level", "activity_level_idx").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _feature_vector(df: DataFrame) -> DataFrame:
    """Length and total of the stress features of every row."""
    rows = files.stored(models.known_categories(models.prepare_ml(df)))
    rows = models.category_indexers().fit(rows).transform(rows)
    total = F.aggregate("values", F.lit(0.0), lambda total, value: total + value)
    shown = models.assembler(models.STRESS_FEATURES, "features").transform(rows).select(
        "user_id", "date_key", vector_to_array("features").alias("values")
    )
    return shown.select("user_id", "date_key", F.size("values").alias("features"), F.round(total, 2).alias("total"))


def _prediction_actuals(df: DataFrame) -> DataFrame:
    """Keys, actual values and split of the scored rows."""
    return models.train_and_score(df, with_split=True).drop(*[target.predicted for target in models.TARGETS])


def _prediction_checks(df: DataFrame) -> DataFrame:
    """What must hold for the predictions whatever the trees are: rows, keys, no nulls, known labels, some learning."""
    scored = models.train_and_score(df, with_split=True)
    is_train = F.col("split") == "train"
    labels = {"stress": STRESS_LABELS, "sleep": tuple(label for _, label in SLEEP_BINS if label)}
    checks = [
        F.count("*").alias("rows"),
        F.count_distinct("user_id", "date_key").alias("keys"),
        F.count_if(reduce(or_, [F.col(t.predicted).isNull() for t in models.TARGETS])).alias("nulls"),
    ]
    for target in models.TARGETS:
        if target.classes:
            known = labels[target.name]
            right = F.count_if(is_train & (F.col(target.predicted) == F.col(target.actual)))
            most = F.greatest(*[F.count_if(is_train & (F.col(target.actual) == label)) for label in known])
            checks.append((F.count_if(~F.col(target.predicted).isin(*known)) == 0).alias(f"{target.name}_known"))
            checks.append((right >= most).alias(f"{target.name}_learnt"))
        else:
            # Against the mean of the train rows, whose squared error is their variance.
            error = F.avg(F.when(is_train, F.pow(F.col(target.predicted) - F.col(target.actual), 2)))
            checks.append((error < F.var_pop(F.when(is_train, F.col(target.actual)))).alias(f"{target.name}_learnt"))
    return scored.agg(*checks)


def _category_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of gender, with the category each counts as."""
    rows = raw_log(spark, sf_dir).select("gender")
    domains = {"category": models.CATEGORIES["gender"]}
    mapped = models.known_categories(rows.withColumn("category", F.col("gender")), domains)
    return mapped.groupBy("gender", "category").agg(F.count(F.lit(1)).alias("rows"))


def _bronze_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log written as CSV, then read, checked, stamped and stored by the bronze stage."""
    folder = files.scratch_dir(spark)
    files.write_csv(raw_log(spark, sf_dir), f"{folder}/raw")
    return run_bronze(spark, f"{folder}/raw", f"{folder}/bronze").drop(INGEST_TS)


def _bronze_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log in two sets of files whose headers differ in order, read as one."""
    folder = files.scratch_dir(spark)
    raw = files.stored(raw_log(spark, sf_dir))
    even = F.col("steps") % 2 == 0
    files.write_csv(raw.filter(even), f"{folder}/raw/as-is")
    files.write_csv(raw.filter(~even).select(*reversed(raw.columns)), f"{folder}/raw/reversed")
    return files.read_daily_csv(spark, f"{folder}/raw/*")


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the raw log that do not parse, after every third steps value was spoilt."""
    folder = files.scratch_dir(spark)
    raw = raw_log(spark, sf_dir)
    spoilt = raw.withColumn("steps", F.when(F.col("steps") % 3 == 0, F.concat(F.lit("about "), "steps")).otherwise(F.col("steps").cast("string")))
    files.write_csv(spoilt, f"{folder}/raw")
    _, bad = files.split_rejects(files.read_daily_csv(spark, f"{folder}/raw", keep_rejects=True))
    return bad.groupBy("user_id").agg(F.count(F.lit(1)).alias("rejected"))


def _silver_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched log exported as CSV with its derived columns, and read back."""
    folder = files.scratch_dir(spark)
    silver = _shown(silver_frame(spark, sf_dir))
    files.write_csv(silver, f"{folder}/silver")
    return spark.read.schema(silver.schema).option("header", True).csv(f"{folder}/silver")


def _clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned log exported as CSV and read back."""
    folder = files.scratch_dir(spark)
    files.write_csv(clean.clean_log(raw_log(spark, sf_dir)), f"{folder}/clean")
    return clean.parse_date(files.read_daily_csv(spark, f"{folder}/clean", multiline=False))


def _stream_frames(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two arrivals of CSV files, each ingested when it lands and followed by a refresh of silver."""
    folder = files.scratch_dir(spark)
    raw = files.stored(raw_log(spark, sf_dir))
    arrival = F.col("age") % 2
    for part in (0, 1):
        files.write_csv(raw.filter(arrival == part), f"{folder}/raw/arrival-{part}")
        incremental.ingest_new_files(spark, f"{folder}/raw/*", f"{folder}/bronze", f"{folder}/ingest", multiline=False)
        incremental.refresh_silver(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/refresh")
    return f"{folder}/bronze", f"{folder}/silver"


def _stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, _ = _stream_frames(spark, sf_dir)
    return files.read_table(spark, bronze).drop(INGEST_TS, incremental.BUCKET)


def _stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, silver = _stream_frames(spark, sf_dir)
    return _shown(files.read_table(spark, silver).drop(INGEST_TS, incremental.BUCKET))


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Three arrivals in the order of days, but for a fifth of the users, whose first days come last; (silver, gold)."""
    folder = files.scratch_dir(spark)
    raw = files.stored(raw_log(spark, sf_dir))
    late = (F.col("user_id") % 5 == 1) & (F.col("date") < "1995-10-01")
    arrival = F.when(late, 2).when(F.col("date") < "1997-04-01", 0).when(F.col("date") < "1999-07-01", 1).otherwise(2)
    silver, gold_path = f"{folder}/silver", f"{folder}/gold"
    for part in (0, 1, 2):
        files.write_csv(raw.filter(arrival == part), f"{folder}/raw/arrival-{part}")
        incremental.ingest_new_files(spark, f"{folder}/raw/*", f"{folder}/bronze", f"{folder}/ingest", multiline=False)
        keyed.append_silver(
            spark,
            f"{folder}/bronze",
            silver,
            f"{folder}/append",
            after=lambda session, batch: gold.apply_batch(session, silver, gold_path, batch),
        )
    return silver, gold_path


def _header_stream(spark: SparkSession, sf_dir: str) -> str:
    """Files of two orders of columns land in one folder, two at a time; the folder of bronze and of its counts."""
    folder = files.scratch_dir(spark)
    raw = files.stored(raw_log(spark, sf_dir))
    for part in (0, 1):
        shown = raw.filter(F.col("age") % 2 == part)
        turned = shown.select(*reversed(shown.columns))
        files.write_csv(turned if part else shown, f"{folder}/raw/arrival-{part}")
        paths = (f"{folder}/raw/*/*.csv", f"{folder}/bronze", f"{folder}/ingest")
        incremental.ingest_by_header(spark, *paths, multiline=False, max_files=8, counts_path=f"{folder}/counts")
    return folder


def _header_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = files.read_table(spark, f"{_header_stream(spark, sf_dir)}/bronze")
    return bronze.drop(INGEST_TS, incremental.BUCKET, incremental.BATCH)


def _header_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the batches of a stream say they wrote, beside those that are there."""
    folder = _header_stream(spark, sf_dir)
    there = files.read_table(spark, f"{folder}/bronze").agg(F.count("*").alias("rows_there"))
    said = files.read_table(spark, f"{folder}/counts").agg(F.sum("rows").alias("rows_said"))
    return there.join(said)


def _append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written to silver by each of three arrivals."""
    silver, _ = _arrivals(spark, sf_dir)
    return files.read_table(spark, keyed.counts_path(silver)).select("batch", "rows")


def _append_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, _ = _arrivals(spark, sf_dir)
    return _shown(keyed.current_silver(spark, silver).drop(INGEST_TS, incremental.BUCKET, keyed.BATCH))


def _append_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.fact_daily(spark, _arrivals(spark, sf_dir)[0]), ["height_cm", "bmr"])


def _append_dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_user(spark, _arrivals(spark, sf_dir)[1])


def _append_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(spark, _arrivals(spark, sf_dir)[1])


def all_queries() -> dict[str, Query]:
    lags = {"weight_prev": ("weight_kg", 1), "lag1_stress": ("stress_level", 1), "lag1_sleep_hours": ("sleep_hours", 1)}
    change_30 = {"weight_change_30d": "weight_kg", "stress_change_30d": "stress_level"}
    change_7 = {"weight_change_7d": "weight_kg", "stress_change_7d": "stress_level"}
    return {
        # cleaning
        "clip_negative": _on(daily_log, clean.clip_negative),
        "range_filter": _on(daily_log, clean.range_filter),
        "drop_zero_steps": _on(daily_log, clean.drop_nonpositive),
        "dedup_rows": _on(raw_log, clean.dedup_rows),
        "parse_date": _on(raw_log, clean.parse_date),
        "drop_null_keys": _on(raw_log, clean.drop_null_keys),
        "clean": _on(raw_log, clean.clean_log),
        # quality reports
        "all_null_columns": _on(lambda s, d: raw_log(s, d).withColumn("note", F.lit(None).cast("string")), quality.all_null_columns),
        "missing_values": _on(raw_log, quality.null_profile),
        "duplicate_rows": _on(raw_log, quality.duplicate_count),
        "outlier_report": _on(raw_log, quality.outlier_report),
        "outlier_rate": _on(raw_log, quality.outlier_rate),
        "zero_audit": _on(raw_log, quality.zero_audit),
        "describe_numeric": _on(daily_log, lambda df: quality.describe_numeric(df, DESCRIBED)),
        "age_distribution": _on(daily_log, quality.age_distribution),
        "completeness": _completeness,
        "category_distribution": _on(
            silver_frame, lambda df: quality.category_distribution(df, ("gender", "activity_level", "sleep_quality", "bmi_category"))
        ),
        "quality_issues": _on(raw_log, quality.quality_issues),
        # labels, calendar, body metrics
        "activity_one_hot": _added(
            clean_frame,
            lambda df: scalar.one_hot_bins(df, "steps", ACTIVITY_FLAGS, "activity_level"),
            *[f"activity_level_{label}" for label in ACTIVITY_FLAGS],
        ),
        "activity_level": _added(
            daily_log, lambda df: scalar.bucketize(df, "steps", ACTIVITY_BINS, "activity_level", "active"), "steps", "activity_level"
        ),
        "sleep_quality": _added(
            raw_log, lambda df: scalar.bucketize(df, "sleep_hours", SLEEP_BINS, "sleep_quality", "poor"), "sleep_hours", "sleep_quality"
        ),
        "bmi_category": _added(
            clean_frame, lambda df: scalar.bucketize(df, "bmi", BMI_BINS, "bmi_category", "obese"), "bmi", "bmi_category"
        ),
        "bucketize": _added(
            daily_log, lambda df: scalar.bucketize(df, "steps", STEP_BINS, "step_band", closed="right"), "steps", "step_band"
        ),
        "date_parts": _added(clean_frame, scalar.date_parts, "year", "month", "day", "weekday", "weekday_num", "is_weekend"),
        "date_key": _added(clean_frame, lambda df: df.withColumn("date_key", scalar.date_key("date")), "date_key"),
        "height": _added(
            clean_frame, scalar.body_metrics, "height_m", "height_cm", digits=4
        ),
        "bmr": _added(clean_frame, scalar.body_metrics, "bmr", digits=2),
        "caloric_balance": _added(clean_frame, scalar.body_metrics, "caloric_balance", digits=2),
        "stress_change_label": _added(
            silver_frame, lambda df: scalar.delta_label(df, "stress_change_30d"), "stress_change_30d", "stress_change_label"
        ),
        # history
        "lag_features": _added(clean_frame, lambda df: history.lag_features(df, lags), *lags),
        "change_30": _added(clean_frame, lambda df: history.change_over(df, change_30), *change_30),
        "change_7": _added(clean_frame, lambda df: history.change_over(df, change_7, 7), *change_7),
        "clamp_delta": _added(clean_frame, lambda df: history.change_over(df, change_30, clamp=5), *change_30),
        "rolling_avg_30": _added(clean_frame, lambda df: history.rolling_mean(df, MEANS), *MEANS, digits=2),
        "rolling_avg_30_days": _added(
            clean_frame, lambda df: history.rolling_mean(df, MEANS, frame="days"), *MEANS, digits=2
        ),
        "change_30_days": _added(clean_frame, lambda df: history.change_over(df, change_30, frame="days"), *change_30),
        "lag_features_split": _added(clean_frame, lambda df: history.lag_features(df, lags, group_rows=100), *lags),
        "rolling_avg_30_days_split": _added(
            clean_frame, lambda df: history.rolling_mean(df, MEANS, frame="days", group_rows=100), *MEANS, digits=2
        ),
        "rolling_avg_30_split": _added(
            clean_frame, lambda df: history.rolling_mean(df, MEANS, group_rows=100), *MEANS, digits=2
        ),
        # layers
        "silver": _on(silver_frame, _shown),
        "silver_split": lambda s, d: _shown(build_silver(files.stored(raw_log(s, d)), group_rows=100)),
        "dim_user": _on(silver_frame, star.build_dim_user),
        "dim_date": _on(silver_frame, star.build_dim_date),
        "dim_activity": _on(silver_frame, star.build_dim_activity),
        "fact_daily": _on(fact_frame, lambda df: _rounded(df, ["height_cm", "bmr"])),
        "preview": _on(silver_frame, lambda df: star.preview(df.select("user_id", "date", "steps", "activity_level"), ["user_id", "date"])),
        # sources, sinks and streams
        "bronze_csv": _bronze_csv,
        "bronze_csv_mixed_headers": _bronze_csv_mixed_headers,
        "clean_csv": _clean_csv,
        "csv_rejects": _csv_rejects,
        "silver_csv": _silver_csv,
        "stream_bronze": _stream_bronze,
        "stream_silver": _stream_silver,
        "stream_bronze_headers": _header_bronze,
        "stream_bronze_counts": _header_counts,
        "append_silver": _append_silver,
        "append_counts": _append_counts,
        "append_fact_daily": _append_fact,
        "append_dim_user": _append_dim_user,
        "append_dim_date": _append_dim_date,
        # models
        "ml_drop_missing": _on(
            fact_frame,
            lambda df: clean.drop_missing(df, models.REQUIRED).select("user_id", "date_key", *models.REQUIRED),
        ),
        "ml_fill_zero": _on(
            fact_frame,
            lambda df: clean.fill_zero(df, models.ZERO_FILLED).select("user_id", "date_key", *models.ZERO_FILLED),
        ),
        "ml_dataset": _on(fact_frame, models.prepare_ml),
        "hash_split": _on(fact_frame, lambda df: evaluate.hash_split(df.select("user_id", "date_key"))),
        "date_split": _on(fact_frame, lambda df: evaluate.date_split(df.select("user_id", "date_key"), FIRST_TEST_KEY)),
        "merge_outer": _on(fact_frame, _merge),
        "merge_outer_split": _on(fact_frame, lambda df: _merge(df, group_rows=0)),
        "classification_accuracy": _on(fact_frame, _yesterday_as_prediction),
        "regression_error": _on(fact_frame, _no_change_as_prediction),
        "label_index": _on(fact_frame, _label_index),
        "category_domain": _category_domain,
        "category_index": _on(fact_frame, _category_index),
        "feature_vector": _on(fact_frame, _feature_vector),
        "prediction_actuals": _on(fact_frame, _prediction_actuals),
        "prediction_checks": _on(fact_frame, _prediction_checks),
        "predictions": _on(fact_frame, models.train_and_score),
    }
