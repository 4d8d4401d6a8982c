"""Random-forest models over the daily fact: stress change, sleep quality, weight change."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from statistics import median_low

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from daystrata.functions.scalar import change_label
from daystrata.operators.clean import drop_missing, fill_zero
from daystrata.operators.evaluate import classification_metrics, date_split, hash_split, regression_metrics, split_point
from daystrata.plans import forests
from daystrata.sources.files import scratch_dir

LOGGER = logging.getLogger(__name__)

# Columns of the model frame, in order.
MODEL_COLUMNS = (
    "user_id", "date_key", "age", "gender", "steps", "exercise_minutes", "calories_burned", "heart_rate_avg",
    "stress_level", "sleep_hours", "sleep_quality", "activity_level", "ra30_steps", "ra30_calories",
    "ra30_ex_minutes", "ra30_stress", "yesterday_stress", "caloric_balance", "weight_change_30d",
    "stress_change_30d", "weight_kg", "yesterday_sleep", "month", "year", "day", "weekday", "weekday_num",
    "is_weekend",
)

# Columns without which a row cannot be used, and columns whose nulls become 0.
REQUIRED = ("sleep_quality", "activity_level", "sleep_hours")
ZERO_FILLED = (
    "ra30_steps", "ra30_calories", "ra30_ex_minutes", "ra30_stress", "yesterday_stress", "caloric_balance",
    "weight_change_30d", "stress_change_30d", "yesterday_sleep",
)

# Features of the three models.
STRESS_FEATURES = (
    "steps", "ra30_steps", "ra30_ex_minutes", "ra30_stress", "exercise_minutes", "calories_burned", "stress_level",
    "yesterday_stress", "caloric_balance", "weight_change_30d", "age", "heart_rate_avg", "gender_idx",
    "activity_level_idx",
)
SLEEP_FEATURES = (
    "steps", "exercise_minutes", "calories_burned", "ra30_steps", "ra30_calories", "ra30_ex_minutes", "ra30_stress",
    "stress_level", "yesterday_stress", "age", "heart_rate_avg", "caloric_balance", "weight_change_30d",
    "yesterday_sleep", "gender_idx", "activity_level_idx",
)
WEIGHT_FEATURES = (
    "age", "steps", "stress_level", "heart_rate_avg", "calories_burned", "exercise_minutes", "gender_idx",
)


# Known categories; whatever else a column holds counts as unknown.
CATEGORIES = {"gender": ("F", "M"), "activity_level": ("sedentary", "light", "moderate", "active")}

KEYS = ("user_id", "date_key")
# Of the hash that draws the rows to fit on where a caller bounds them; another one than that of the split.
DRAW_SEED = 7

# Forests are fitted on so many partitions, dealt by key and sorted within: bags are drawn by partition and place, so
# only then does the same data give the same trees. A larger cluster may ask for more; that number is part of the result.
FIT_PARTITIONS = 16

# What Spark's own forests keep of a train row between their passes, besides 4 bytes a tree and a feature,
# and how many rows of ours (``forests.packed``) fit the room of one of theirs at least.
OBJECT_BYTES = 100
PACKED_ROWS = 4


def prepare_ml(df: DataFrame, drop_no_history: bool = False) -> DataFrame:
    """Model frame of the daily fact.

    A missing 30-row change counts as no change, which labels the first rows of every user "no_changes";
    ``drop_no_history`` leaves those rows out instead.
    """
    rows = drop_missing(df.select(*MODEL_COLUMNS), REQUIRED)
    if drop_no_history:
        rows = drop_missing(rows, ("weight_change_30d", "stress_change_30d"))
    return fill_zero(rows, ZERO_FILLED)


@dataclass(frozen=True)
class Target:
    """What one model predicts, from what, and the names of its columns in the result."""

    name: str
    label: str
    features: Sequence[str]
    trees: int
    depth: int
    predicted: str
    actual: str
    classes: bool = True
    seed: int = 42

    @property
    def index(self) -> str:
        return f"{self.name}_label_idx" if self.classes else self.label

    @property
    def raw(self) -> str:
        return f"_{self.name}_prediction"

    def predicted_column(self) -> Column:
        return F.col(self.predicted) if self.classes else F.round(self.raw, 3).alias(self.predicted)

    def actual_column(self) -> Column:
        value = F.col(self.label) if self.classes else F.round(self.label, 3)
        return value.alias(self.actual)


# Size, depth and seed of the three forests.
TARGETS = (
    Target(
        "stress", "stress_change_label", STRESS_FEATURES, 80, 6, "predicted_stress_change", "actual_stress_change"
    ),
    Target("sleep", "sleep_quality", SLEEP_FEATURES, 60, 8, "predicted_sleep_quality", "actual_sleep_quality"),
    Target(
        "weight", "weight_change_target", WEIGHT_FEATURES, 80, 8,
        "predicted_weight_change_30d", "actual_weight_change_30d", classes=False,
    ),
)


@dataclass
class Trained:
    """Fitted models by target name, and their metrics on the test rows."""

    shared: PipelineModel
    models: dict[str, PipelineModel] = field(default_factory=dict)
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)


def with_targets(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"stress_change_label": change_label("stress_change_30d"), "weight_change_target": F.col("weight_change_30d")}
    )


def known_categories(df: DataFrame, domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df`` with values outside a column's domain as null, so that there is one bucket for the rest however dirty."""
    domains = CATEGORIES if domains is None else domains
    return df.withColumns({c: F.when(F.col(c).isin(*known), F.col(c)) for c, known in domains.items() if c in df.columns})


def category_indexers(cols: Sequence[str] = tuple(CATEGORIES)) -> Pipeline:
    """Category indexes that all models share, by falling frequency; unknown and missing categories get their own."""
    names = [f"{c}_idx" for c in cols]
    return Pipeline(stages=[StringIndexer(inputCols=list(cols), outputCols=names, handleInvalid="keep")])


def label_indexer(label: str, out: str) -> StringIndexer:
    """Label index, by falling frequency; rows with an unknown label are skipped."""
    return StringIndexer(inputCol=label, outputCol=out, handleInvalid="skip")


def label_names(index: str, out: str, labels: Sequence[str]) -> IndexToString:
    return IndexToString(inputCol=index, outputCol=out, labels=list(labels))


def assembler(features: Sequence[str], out: str) -> VectorAssembler:
    """Feature vector; a null among the features is an error."""
    return VectorAssembler(inputCols=list(features), outputCol=out)


def _fitted(target: Target, rows: DataFrame, labels: list[str] | None, storage: StorageLevel) -> PipelineModel:
    """Feature vector, forest grown on ``rows`` and names of the predicted labels."""
    vector = f"_{target.name}_features"
    common = dict(
        labelCol=target.index, featuresCol=vector, predictionCol=target.raw,
        numTrees=target.trees, maxDepth=target.depth, seed=target.seed,
    )
    features = assembler(target.features, vector)
    if not target.classes:
        return PipelineModel([features, forests.fit(RandomForestRegressor(**common), features.transform(rows), 0, storage)])
    forest = RandomForestClassifier(
        **common, rawPredictionCol=f"_{target.name}_votes", probabilityCol=f"_{target.name}_probability"
    )
    grown = forests.fit(forest, features.transform(rows), len(labels), storage)
    return PipelineModel([features, grown, label_names(target.raw, target.predicted, labels)])


def _with_split(df: DataFrame, train: float, seed: int, first_test_key: int | None) -> DataFrame:
    if first_test_key is not None:
        return date_split(df, first_test_key)
    return hash_split(df, KEYS, train, seed)


def _fitting_rows(rows: DataFrame, fit_rows: int | None = None) -> DataFrame:
    """``rows`` with ``_fit``: train rows for the classifiers; all, or with ``fit_rows`` about so many of them at most."""
    is_train = F.col("split") == "train"
    if fit_rows is None:
        return rows.withColumn("_fit", is_train)
    n = rows.filter(is_train).count()
    share = min(1.0, fit_rows / max(1, n))
    return rows.withColumn("_fit", is_train & (split_point(KEYS, DRAW_SEED) < F.lit(round(share * 2**32))))


def storage_bytes(spark: SparkSession) -> int:
    """Memory for stored blocks of all executors, taken as alike; the driver counts only where it is the sole one."""
    status, sizes = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), []
    while status.hasNext():
        sizes.append(status.next()._1())
    return max(1, len(sizes) - 1) * median_low(sizes)


def at_a_time(targets: Sequence[Target], train_rows: int, fit_rows: int, room: int, parallelism: int) -> int:
    """How many forests train together: all, or two if what they keep, as objects, does not fit ``room`` bytes.

    Forests that do not fit would take turns in reading their rows from disk in every pass. One alone would leave cores idle between its
    passes and in the last wave of each, so there are two even if these do not fit.
    """
    kept = (
        (fit_rows if t.classes else train_rows) * (4 * (t.trees + len(t.features)) + OBJECT_BYTES) for t in targets
    )
    return max(1, min(parallelism, len(targets), len(targets) if sum(kept) <= room else 2))


def train_models(
    rows: DataFrame,
    targets: Sequence[Target] = TARGETS,
    storage: StorageLevel = StorageLevel.DISK_ONLY,
    parallelism: int = 3,
    fit_rows: int | None = None,
    fit_partitions: int = FIT_PARTITIONS,
) -> Trained:
    """Fit all targets on "train" rows of a model frame with targets and ``split``, and measure on the rest.

    All forests are fitted on all train rows; a caller's ``fit_rows`` bounds those of the classifiers (about).

    The indexed frame, cut down to the columns in use, is kept for the forests, in an order that follows from its
    content alone; lost blocks are recomputed from its source. It and the rows that the forests pack for their passes
    are kept on disk. Up to ``parallelism`` models train at a time, as far as their rows would fit memory: their jobs fill
    the gaps that the driver work between levels leaves.
    """
    used = {*KEYS, *CATEGORIES, "split", *(c for t in targets for c in (t.label, *t.features))}
    rows = _fitting_rows(known_categories(rows.select(*[c for c in rows.columns if c in used])), fit_rows)
    trained = Trained(category_indexers().fit(rows.filter(F.col("split") == "train")))
    dealt = rows.repartition(fit_partitions, *KEYS).sortWithinPartitions(*KEYS, *sorted(set(rows.columns) - set(KEYS)))
    indexed = trained.shared.transform(dealt).persist(storage)

    def fit(target: Target) -> None:
        frame, labels = indexed, None
        if target.classes:
            label_model = label_indexer(target.label, target.index).fit(indexed)
            labels = label_model.labels
            frame = label_model.transform(indexed)
        fitting = F.col("_fit") if target.classes else F.col("split") == "train"
        model = _fitted(target, frame.filter(fitting), labels, storage)
        trained.models[target.name] = model
        trained.metrics[target.name] = _measure(model.transform(frame.filter(F.col("split") == "test")), target)
        LOGGER.info("%s model: %s", target.name, trained.metrics[target.name])

    try:
        # This pass also makes the frame, once, before several models ask for it.
        sizes = indexed.agg(F.count_if(F.col("split") == "train"), F.count_if("_fit")).first()
        together = at_a_time(targets, *sizes, PACKED_ROWS * storage_bytes(rows.sparkSession), parallelism)
        with ThreadPool(together) as pool:
            pool.map(inheritable_thread_target(rows.sparkSession)(fit), targets)
    finally:
        indexed.unpersist()
    return trained


def _measure(scored: DataFrame, target: Target) -> dict[str, float | None]:
    """Accuracy and F1, or RMSE and MAE, from one scoring pass; None without test rows."""
    metrics = classification_metrics if target.classes else regression_metrics
    return metrics(scored, target.index, target.raw).first().asDict()


def score(rows: DataFrame, trained: Trained, targets: Sequence[Target] = TARGETS, with_split: bool = False) -> DataFrame:
    """Predicted and actual value of every target for every row.

    All models score the same frame one after the other, in one narrow stage: where keys are unique this gives the
    rows of a full outer join of separate predictions without shuffling them.
    """
    scored = trained.shared.transform(known_categories(rows))
    for target in targets:
        scored = trained.models[target.name].transform(scored)
    columns = [c for target in targets for c in (target.predicted_column(), target.actual_column())]
    return scored.select(*KEYS, *columns, *(["split"] if with_split else []))


def train_and_score(
    fact: DataFrame,
    train: float = 0.8,
    seed: int = 42,
    first_test_key: int | None = None,
    drop_no_history: bool = False,
    with_split: bool = False,
    targets: Sequence[Target] = TARGETS,
    fit_rows: int | None = None,
    fit_partitions: int = FIT_PARTITIONS,
) -> DataFrame:
    """Train on part of the daily fact and predict for all of it.

    Rows are split by a hash of their key, or with ``first_test_key`` by day. The model frame is written to the shared
    scratch folder once; training and scoring read it there, so what leads up to it runs a single time.
    """
    rows = _with_split(with_targets(prepare_ml(fact, drop_no_history)), train, seed, first_test_key)
    path = scratch_dir(fact.sparkSession)
    rows.write.parquet(path)
    stored = fact.sparkSession.read.schema(rows.schema).parquet(path)
    return score(stored, train_models(stored, targets, fit_rows=fit_rows, fit_partitions=fit_partitions), targets, with_split)
