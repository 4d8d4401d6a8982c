"""The forests grown over packed rows are those of Spark."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from daystrata.plans import forests


@pytest.fixture(scope="module")
def rows(spark):
    """Categories few and many, a feature of mostly zeros, one of fractions, one that never varies."""
    hashed = [(F.xxhash64("id", F.lit(i)) % 1000 + 1000) % 1000 for i in range(6)]
    df = spark.range(0, 14_000, 1, 3).select(
        "id",
        F.concat(F.lit("c"), hashed[0] % 3).alias("few"),
        F.concat(F.lit("d"), hashed[1] % 9).alias("many"),
        F.when(hashed[2] < 300, hashed[2] - 150).otherwise(0).cast("double").alias("zeros"),
        (hashed[3] / 7.0).alias("part"),
        F.lit(2.5).alias("same"),
        (hashed[4] % 4).cast("double").alias("small"),
        hashed[5].alias("noise"),
    )
    score = F.col("part") + F.col("small") * 30 + F.when(F.col("few") == "c1", 40).otherwise(0) + F.col("noise") / 20
    df = df.withColumns({"value": score / 3, "label": F.when(score > 150, 2.0).when(score > 100, 1.0).otherwise(0.0)})
    df = df.withColumn("half", F.when(F.col("label") > 0, 1.0).otherwise(0.0)).repartition(5, "id").sortWithinPartitions("id")
    indexer = StringIndexer(inputCols=["few", "many"], outputCols=["few_idx", "many_idx"], handleInvalid="keep")
    assembler = VectorAssembler(inputCols=["few_idx", "zeros", "part", "same", "small", "many_idx"], outputCol="features")
    return assembler.transform(indexer.fit(df).transform(df)).select("id", "features", "label", "half", "value").persist()


def assert_same(forest, rows, classes, scored=None):
    # The copy leaves out the training summary, which would drag its session into every task.
    packed, spark_made = forests.fit(forest, rows, classes), forest.fit(rows).copy()
    own = packed.spark_model(rows.sparkSession)
    assert own.toDebugString.split("\n", 1)[1] == spark_made.toDebugString.split("\n", 1)[1]
    shown = ["prediction", *(["rawPrediction"] if classes else [])]
    assert own.transform(rows).select(shown).collect() == spark_made.transform(rows).select(shown).collect()
    # Also for rows that were not trained on.
    scored = rows if scored is None else scored
    assert packed.transform(scored).select("prediction").collect() == spark_made.transform(scored).select("prediction").collect()


@pytest.mark.parametrize("n", [40, 14_000])
@pytest.mark.parametrize("label, classes", [("label", 3), ("half", 2), ("value", 0)])
def test_trees_are_those_of_spark(rows, n, label, classes):
    """With thresholds of all values and of a sample, categories that are ordered and that are not, leaves of one row."""
    kind = RandomForestClassifier if classes else RandomForestRegressor
    assert_same(kind(labelCol=label, numTrees=7, maxDepth=5, seed=11), rows.filter(F.col("id") < n), classes, rows)


def test_little_memory_and_one_tree(rows):
    """Nodes that do not fit a pass wait for the next one; a single tree tries all features at each node."""
    some = rows.filter("id < 300")
    assert_same(RandomForestClassifier(labelCol="label", numTrees=2, maxDepth=2, seed=3, maxMemoryInMB=0), some, 3)
    assert_same(RandomForestRegressor(labelCol="value", numTrees=1, maxDepth=3, seed=3), some, 0)


def test_one_class(rows):
    forest = RandomForestClassifier(labelCol="label", numTrees=5, maxDepth=3, seed=3)
    only = StringIndexer(inputCol="only", outputCol="label").fit(some := rows.limit(200).drop("label").withColumn("only", F.lit("x")))
    assert_same(forest, only.transform(some), 1)


def test_rows_are_packed(rows):
    """A byte a feature and a byte a tree: with objects a row of 80 trees took 100 bytes and 4 more a tree and a feature."""
    forest = RandomForestClassifier(labelCol="label", numTrees=80, seed=1)
    shape = forests.shape_of(forest, rows, 3)
    blocks = forests.packed(rows, shape, "label", "features", 80, 1)
    sizes = blocks.agg(F.sum("n"), F.sum(F.length("bins") + F.length("labels") + F.length("bags"))).first()
    assert tuple(sizes) == (14_000, 14_000 * (6 + 8 + 80))


def test_bags_repeat_and_differ_by_partition(spark):
    df = spark.range(0, 3000, 1, 3).select("id", F.spark_partition_id().alias("part"), forests.bag_counts(spark, 4, 5, 3).alias("bag"))
    first, again = df.collect(), df.collect()
    assert first == again
    parts = [[r.bag for r in first if r.part == p] for p in range(3)]
    assert parts[0] != parts[1] != parts[2]
    mean = sum(sum(bag) for part in parts for bag in part) / 12_000
    assert 0.95 < mean < 1.05


def test_what_cannot_be_trained_on_is_refused(rows):
    forest = RandomForestRegressor(labelCol="value", numTrees=2, maxDepth=2)
    with pytest.raises(ValueError, match="at least one row"):
        forests.fit(forest, rows.filter("id < 0"))
    with pytest.raises(ValueError, match="categories"):
        forests.fit(forest, rows.filter("id < 4"))
    with pytest.raises(Exception, match="null, NaN or infinite"):
        forests.fit(forest, rows.withColumn("value", F.when(F.col("id") != 7, F.col("value"))))


def test_maps_go_through_their_keys_as_in_scala(spark):
    build = spark._jvm.org.apache.spark.api.python.PythonUtils.toScalaMap
    for keys in (range(80), range(60), [3, 20, 17], [40, 2, 9, 33, 64, 71]):
        held = build({k: True for k in sorted(keys, key=lambda k: (k & 15, k))})
        order, entries = [], held.keysIterator()
        while entries.hasNext():
            order.append(entries.next())
        assert forests.map_order(keys) == order
