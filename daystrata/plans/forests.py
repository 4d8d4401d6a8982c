"""Spark's random forests, grown over packed rows.

The trees are those of ``RandomForestClassifier`` and ``RandomForestRegressor`` for the same frame and seed: thresholds
from the same sample of values, the same bags, the same features tried at each node, nodes split in the same order and
sums added in the order of the rows. Only the passes differ. A train row is kept as a byte a feature and a byte a tree
instead of as objects, and a pass adds up whole blocks of rows; so it takes a fraction of the time and of the room.
"""

from __future__ import annotations

import json
import math
import struct
import sys
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from daystrata.sources.files import scratch_dir

# Functions that run in tasks travel with the task, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MASK32, MASK64 = 2**32 - 1, 2**64 - 1
EPSILON = 2.0**-52
INVALID = -np.finfo(np.float64).max  # gain of a split that is not allowed
# Values that thresholds are looked for in (about), as many as Spark takes.
THRESHOLD_ROWS = 10_000

PACKED = "n int, bins binary, labels binary, bags binary"
SUMS = "tree int, part int, sums binary"
SPLITS = (
    "tree int, node int, feature int, at int, categories array<int>, gain double, impurity double,"
    " stats array<double>, left array<double>, right array<double>, left_impurity double, right_impurity double"
)
NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint,"
    " gain double, leftChild int, rightChild int,"
    " split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


# --- random numbers as the JVM draws them


class JavaRandom:
    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & (2**48 - 1)

    def _next32(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (2**48 - 1)
        return _signed(self.state >> 16, 32)

    def next_long(self) -> int:
        high = self._next32() << 32
        return _signed(high + self._next32(), 64)


def _signed(value: int, bits: int) -> int:
    value &= (1 << bits) - 1
    return value - (1 << bits) if value >> (bits - 1) else value


def _murmur(words: Iterable[int], seed: int, length: int) -> int:
    h = seed
    for k in words:
        k = k * 0xCC9E2D51 & MASK32
        k = (k << 15 | k >> 17) & MASK32
        h ^= k * 0x1B873593 & MASK32
        h = (h << 13 | h >> 19) & MASK32
        h = h * 5 + 0xE6546B64 & MASK32
    h ^= length
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK32
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK32
    return h ^ h >> 16


class XorShift:
    """Spark's ``XORShiftRandom``."""

    def __init__(self, seed: int) -> None:
        words = struct.unpack("<2I", struct.pack(">q", seed))
        low = _murmur(words, 0x3C074A61, 8)
        self.state = _murmur(words, low, 8) << 32 | low

    def bits(self, n: int) -> int:
        x = self.state
        x ^= x << 21 & MASK64
        x ^= x >> 35
        x ^= x << 4 & MASK64
        self.state = x
        return x & ((1 << n) - 1)

    def next_int(self) -> int:
        return _signed(self.bits(32), 32)

    def next_double(self) -> float:
        return ((_signed(self.bits(26), 32) << 27) + self.bits(27)) * 2.0**-53


def reservoir(n: int, k: int, seed: int) -> list[int]:
    """``k`` of the numbers below ``n``, in the order Spark's reservoir holds them."""
    held, draw = list(range(min(k, n))), XorShift(seed)
    for item in range(k, n):
        place = int(draw.next_double() * (item + 1))
        if place < k:
            held[place] = item
    return held


def map_order(keys: Iterable[int]) -> list[int]:
    """``keys`` in the order in which an immutable Scala map made from a mutable one goes through them."""
    keys = list(keys)
    if len(keys) <= 4:
        return sorted(keys, key=lambda k: ((k ^ k >> 16) & 15, k))

    def improved(code: int) -> int:
        h = code + ~(code << 9) & MASK32
        h ^= h >> 14
        h = h + (h << 4) & MASK32
        return h ^ h >> 10

    def walk(group: list[tuple[int, int]], shift: int) -> list[int]:
        if shift >= 32:
            return [k for _, k in group]
        slots: dict[int, list[tuple[int, int]]] = {}
        for entry in group:
            slots.setdefault(entry[0] >> shift & 31, []).append(entry)
        ordered = sorted(slots.items())
        alone = [members[0][1] for _, members in ordered if len(members) == 1]
        return alone + [k for _, members in ordered if len(members) > 1 for k in walk(members, shift + 5)]

    return walk([(improved(k), k) for k in keys], 0)


# --- what a forest is grown from


@dataclass
class Shape:
    """Features with their bins, and what is counted of a node; as Spark's ``DecisionTreeMetadata``."""

    classes: int  # 0 for a regression
    arity: dict[int, int]  # categories by feature
    unordered: frozenset[int]
    thresholds: list[np.ndarray]  # by feature; none for categories
    bins: list[int]  # by feature, as Spark counts them
    per_node: int
    min_rows: int
    min_gain: float

    @property
    def features(self) -> int:
        return len(self.bins)

    @property
    def width(self) -> int:
        """Bins of a row's value in any feature."""
        return max(len(self.thresholds[f]) + 1 if f not in self.arity else max(self.bins[f], self.arity[f]) for f in range(self.features))

    @property
    def stats(self) -> int:
        return self.classes or 3

    def splits(self, f: int) -> int:
        return self.bins[f] if f in self.unordered else self.bins[f] - 1

    def node_bytes(self, tried: Sequence[int]) -> int:
        return 8 * (self.classes if self.classes > 1 else 3) * sum(self.bins[f] for f in tried)


def category_counts(rows: DataFrame, vector: str) -> dict[int, int]:
    """Number of categories of the nominal features of a vector column."""
    attrs = rows.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: a["num_vals"] if "num_vals" in a else len(a["vals"]) for a in attrs.get("nominal", [])}
    return nominal | {a["idx"]: 2 for a in attrs.get("binary", [])}


def find_thresholds(values: np.ndarray, most: int, fraction: float, rows: int) -> np.ndarray:
    """Thresholds between the sampled ``values`` of a feature, ``most`` at most, for parts of about equal size."""
    values = values[values != 0.0]
    if not len(values):
        return np.empty(0)
    found, counts = np.unique(values, return_counts=True)
    expected, seen = fraction * float(rows), float(counts.sum())
    weights = counts.astype(np.float64)
    if expected - seen > EPSILON * len(values) * 100:
        place = int(np.searchsorted(found, 0.0))
        found, weights = np.insert(found, place, 0.0), np.insert(weights, place, expected - seen)
    possible = len(found) - 1
    between = (found[:-1] + found[1:]) / 2.0
    if possible <= most:
        return between
    stride = expected / (most + 1)
    kept, current, target = [], float(weights[0]), stride
    for i in range(1, len(found)):
        before, current = current, current + float(weights[i])
        if abs(before - target) < abs(current - target):
            kept.append(between[i - 1])
            target += stride
    return np.array(kept)


def _sampled(rows: DataFrame, vector: str, fraction: float, seed: int) -> np.ndarray:
    """Feature values of the rows that Spark's forests look for thresholds in, one row a line."""
    spark, shown = rows.sparkSession, rows.select(vector_to_array(vector).alias("values"))
    if fraction < 1:
        # A sample of the RDD, as other rows would come from a sample of the frame.
        sample = shown._jdf.rdd().sample(False, fraction, XorShift(seed).next_int())
        shown = DataFrame(spark._jsparkSession.createDataFrame(sample.toJavaRDD(), shown._jdf.schema()), spark)
    return np.array([row[0] for row in shown.collect()], dtype=np.float64)


def shape_of(forest: RandomForestClassifier | RandomForestRegressor, rows: DataFrame, classes: int) -> Shape:
    vector = forest.getFeaturesCol()
    n = rows.count()
    if not n:
        raise ValueError("a forest needs at least one row to train on")
    arity, most = category_counts(rows, vector), min(forest.getMaxBins(), n)
    if max(arity.values(), default=0) > most:
        raise ValueError(f"a feature has {max(arity.values())} categories, more than {most}, the bins or rows there are")
    wanted = max(forest.getMaxBins() ** 2, THRESHOLD_ROWS)
    fraction = wanted / n if wanted < n else 1.0
    sample = _sampled(rows, vector, fraction, forest.getSeed())
    features = sample.shape[1] if sample.ndim == 2 else rows.select(F.size(vector_to_array(vector))).first()[0]
    sample = sample.reshape(-1, features)
    bins, thresholds, unordered = [most] * features, [np.empty(0)] * features, set()
    few = math.floor(math.log(most // 2 + 1) / math.log(2.0) + 1)
    for f, count in arity.items():
        if classes > 2 and 1 < count <= few:
            unordered.add(f)
            bins[f] = (1 << count - 1) - 1
        elif count > 1:
            bins[f] = count
    for f in range(features):
        if f not in arity:
            thresholds[f] = find_thresholds(sample[:, f], most - 1, fraction, n)
            bins[f] = len(thresholds[f]) + 1
    if forest.getNumTrees() == 1:
        per_node = features
    else:
        per_node = math.ceil(math.sqrt(features)) if classes else math.ceil(features / 3.0)
    return Shape(
        classes, arity, frozenset(unordered), thresholds, bins, per_node,
        forest.getMinInstancesPerNode(), forest.getMinInfoGain(),
    )


def bag_counts(spark: SparkSession, trees: int, seed: int, partitions: int) -> Column:
    """How often each tree takes a row, as Spark's bags: drawn in the order of the rows from a seed for each partition.

    Every task has its own copy of the generators, so it draws the same numbers whenever it runs.
    """
    jvm, catalyst = spark._jvm, spark._jvm.org.apache.spark.sql.catalyst.expressions
    object_type, python = jvm.org.apache.spark.sql.types.ObjectType, jvm.PythonUtils
    draws = jvm.java.util.ArrayList()
    for part in range(partitions):
        poisson = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
        poisson.reseedRandomGenerator(seed + part + 1)
        draws.add(poisson)

    def invoke(target, name, kind, argument):
        return catalyst.objects.Invoke(
            target, name, kind, python.toSeq([argument]), python.toSeq([]), True, True, False
        )

    ints = jvm.java.lang.Class.forName("[I")
    held = catalyst.Literal(draws, object_type(draws.getClass()))
    own = invoke(held, "get", object_type(draws.get(0).getClass()), catalyst.SparkPartitionID())
    counts = invoke(own, "sample", object_type(ints), catalyst.Literal(trees, jvm.org.apache.spark.sql.types.DataType.fromDDL("int")))
    array = catalyst.objects.StaticInvoke(
        jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.UnsafeArrayData"),
        jvm.org.apache.spark.sql.types.ArrayType(jvm.org.apache.spark.sql.types.DataType.fromDDL("int"), False),
        "fromPrimitiveArray", python.toSeq([counts]), python.toSeq([]), True, True, False, jvm.scala.Option.empty(),
    )
    return Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(array))


def binned(shape: Shape, values: np.ndarray) -> np.ndarray:
    """The bin of every value, a row a line and a feature a column."""
    bins = np.empty(values.shape, np.uint8)
    for f in range(shape.features):
        column = values[:, f]
        bins[:, f] = column if f in shape.arity else np.searchsorted(shape.thresholds[f], column)
    return bins


def packed(rows: DataFrame, shape: Shape, label: str, vector: str, trees: int, seed: int) -> DataFrame:
    """Blocks of ``rows``: the bin of every feature, the label, and how often each tree takes the row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            labels, vectors, bags = batch.columns
            values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, shape.features)
            target = labels.to_numpy(zero_copy_only=False)
            if labels.null_count or not np.isfinite(values).all() or np.isnan(target).any():
                raise ValueError("labels and features must not be null, NaN or infinite")
            bins = binned(shape, values)
            counts = bags.flatten().to_numpy().astype(np.uint8).reshape(n, trees).T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n], pa.int32()),
                    *[pa.array([a.tobytes()], pa.binary()) for a in (bins, target, np.ascontiguousarray(counts))],
                ],
                ["n", "bins", "labels", "bags"],
            )

    drawn = bag_counts(rows.sparkSession, trees, seed, rows.rdd.getNumPartitions())
    shown = rows.select(F.col(label).cast("double").alias("label"), vector_to_array(vector).alias("values"), drawn.alias("bags"))
    return shown.mapInArrow(pack, PACKED)


# --- a pass over the rows


@dataclass
class Growing:
    """What a pass has to know of one tree: its splits so far, the nodes to split now and the features they try."""

    splits: tuple[np.ndarray, np.ndarray, np.ndarray]  # of ``Tree.packed``
    nodes: list[int]
    tried: np.ndarray  # by place of the node in ``nodes``

    @property
    def depth(self) -> int:
        return max(self.nodes).bit_length() - 1


@dataclass
class Choosing:
    """What the choice of splits has to know of one tree: nodes, features they try, what their parents' splits told."""

    nodes: list[int]
    tried: np.ndarray
    known: tuple[np.ndarray, np.ndarray] | None  # stats and impurities by place; none for the root


def unpacked(splits: tuple[np.ndarray, np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature by node, node that a row goes on to by node and bin); nodes that are not split keep their rows."""
    feature, inner, left = splits
    ids = np.arange(len(inner))[:, None]
    left = np.unpackbits(left, axis=1, count=width).astype(bool)
    return feature.astype(np.int64), np.where(inner[:, None], 2 * ids + ~left, ids).astype(np.int64).ravel()


def _held(value: pa.Scalar, kind: type) -> np.ndarray:
    """The numbers in a binary value, where they are."""
    return np.frombuffer(value.as_buffer(), kind)


def _walked(node: np.ndarray, steps: int, feature: np.ndarray, ways: np.ndarray, bins: np.ndarray, starts: np.ndarray, width: int):
    """The nodes that rows reach from ``node``; ``starts`` has the places of their first bins."""
    for _ in range(steps):
        way = bins.take(starts + feature.take(node))
        node = node * width
        node += way
        node = ways.take(node)
    return node


def _sums_of(shape: Shape, growing: dict[int, Growing]):
    """Function for ``mapInArrow``: sums of the blocks of a partition by tree, node, feature tried, bin and class."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, stats, features = shape.width, shape.stats, shape.features
        tries = next(iter(growing.values())).tried.shape[1]
        ways, places, columns, sums = {}, {}, {}, {}  # features and ways, and so on, by tree
        cells = tries * width * (shape.classes or 1)
        for t, g in growing.items():
            ways[t] = unpacked(g.splits, width)
            places[t] = np.full(len(ways[t][0]), -1, np.int64)
            places[t][g.nodes] = np.arange(len(g.nodes))
            columns[t] = np.ascontiguousarray(g.tried.T.astype(np.int64))
            sums[t] = np.zeros((1 if shape.classes else stats, len(g.nodes) * cells))
        any_row = False
        for batch in batches:
            for i, n in enumerate(batch.column(0).to_pylist()):
                any_row = True
                bins, labels, bags = (_held(batch.column(c + 1)[i], kind) for c, kind in enumerate((np.uint8, np.float64, np.uint8)))
                bags = bags.reshape(-1, n)
                classes = labels.astype(np.int64) if shape.classes else None
                for t, g in growing.items():
                    rows = np.flatnonzero(bags[t])
                    starts = rows * features
                    node = _walked(np.ones(len(rows), np.int64), g.depth, *ways[t], bins, starts, width)
                    place = places[t].take(node)
                    if g.depth and place.min(initial=0) < 0:
                        on = np.flatnonzero(place >= 0)
                        rows, starts, place = rows.take(on), starts.take(on), place.take(on)
                    weights = bags[t].take(rows).astype(np.float64)
                    cell = place * cells
                    if shape.classes:
                        cell += classes.take(rows)
                        amounts = [weights]
                    else:
                        own = labels.take(rows)
                        total = weights * own
                        amounts = [weights, total, total * own]
                    for column in columns[t]:
                        at = column.take(place)
                        at += starts
                        at = bins.take(at) * np.int64(shape.classes or 1)
                        at += cell
                        # One after the other, so that sums of fractions are rounded as Spark rounds them.
                        for kind, amount in zip(sums[t], amounts, strict=True):
                            np.add.at(kind, at, amount)
                        cell += width * (shape.classes or 1)
        if any_row:
            part = TaskContext.get().partitionId()
            for t, total in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                    ["tree", "part", "sums"],
                )

    return add


def _impurity(shape: Shape, stats: np.ndarray) -> np.ndarray:
    """Gini impurity, or variance, of each line of ``stats``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if shape.classes:
            total = stats.sum(axis=-1)
            impurity = np.ones(total.shape)
            for c in range(shape.classes):
                share = stats[..., c] / total
                impurity -= share * share
        else:
            total = stats[..., 0]
            impurity = (stats[..., 2] - stats[..., 1] * stats[..., 1] / total) / total
    return np.where(total == 0, 0.0, impurity)


def _rows(shape: Shape, stats: np.ndarray) -> np.ndarray:
    return stats.sum(axis=-1) if shape.classes else stats[..., 0]


def predicted(shape: Shape, stats: Sequence[float]) -> float:
    if shape.classes:
        return float(int(np.argmax(stats))) if sum(stats) else 0.0
    return stats[1] / stats[0] if stats[0] else 0.0


def _candidates(shape: Shape, f: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, object]:
    """(left, right) of every split of a feature from the sums of its bins, and what tells the splits apart."""
    n = shape.splits(f)
    if f not in shape.arity:
        upto = np.cumsum(sums[: n + 1], axis=0)
        return upto[:-1], upto[-1] - upto[:-1], None
    if f in shape.unordered:
        member = (np.arange(1, n + 1)[:, None] >> np.arange(shape.arity[f])) & 1
        left = member.astype(np.float64) @ sums[: shape.arity[f]]
        return left, sums.sum(axis=0) - left, member
    sums = sums[: n + 1]
    count = _rows(shape, sums)
    if shape.classes:
        # With a single class there is nothing to order by.
        centre = _impurity(shape, sums) if shape.classes != 2 else sums[:, 1]
    else:
        centre = sums[:, 1] / np.where(count == 0, 1.0, count)
    order = np.argsort(np.where(count == 0, np.finfo(np.float64).max, centre), kind="stable")
    upto = np.cumsum(sums[order], axis=0)
    return upto[:-1], upto[-1] - upto[:-1], order


def best_split(shape: Shape, sums: np.ndarray, tried: Sequence[int], known: tuple[np.ndarray, float] | None) -> tuple:
    """(feature, place, left categories, gain, impurity, stats, left, right, their impurities) of the best split."""
    best, parent, impurity = None, None, None
    if known is not None:
        parent, impurity = known
    for f, own in zip(tried, sums, strict=True):
        f = int(f)
        if not shape.splits(f):
            continue
        left, right, how = _candidates(shape, f, own)
        if parent is None:
            parent = left[0] + right[0]
            impurity = float(_impurity(shape, parent))
        n_left, n_right = _rows(shape, left), _rows(shape, right)
        l_impurity, r_impurity = _impurity(shape, left), _impurity(shape, right)
        total = n_left + n_right
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = impurity - n_left / total * l_impurity - n_right / total * r_impurity
        barred = (n_left < shape.min_rows) | (n_right < shape.min_rows) | ~(gain >= shape.min_gain)
        gain = np.where(barred, INVALID, gain)
        at = int(np.argmax(gain))
        if best is None or gain[at] > best[3]:
            categories = None
            if f in shape.unordered:
                categories = [c for c in range(shape.arity[f]) if how[at][c]]
            elif f in shape.arity:
                categories = [int(c) for c in how[: at + 1]]
            best = (f, at, categories, float(gain[at]), left[at], right[at], float(l_impurity[at]), float(r_impurity[at]))
    if best is None:
        # All rows are alike in all features tried.
        parent = sums[0].sum(axis=0)
        return int(tried[0]), -1, None, INVALID, float(_impurity(shape, parent)), parent.tolist(), None, None, 0.0, 0.0
    f, at, categories, gain, left, right, l_impurity, r_impurity = best
    if gain == INVALID:
        impurity = float(_impurity(shape, parent))
    return f, at, categories, gain, float(impurity), parent.tolist(), left.tolist(), right.tolist(), l_impurity, r_impurity


def _splits_of(shape: Shape, choosing: dict[int, Choosing]):
    """Function for ``applyInArrow``: the sums of all partitions of a tree, in their order, give its best splits."""

    def choose(table: pa.Table) -> pa.Table:
        t = table["tree"][0].as_py()
        g, total = choosing[t], None
        for i in np.argsort(table["part"].to_numpy()).tolist():
            part = _held(table["sums"][i], np.float64)
            total = part.copy() if total is None else np.add(total, part, out=total)
        tries = g.tried.shape[1]
        if shape.classes:
            total = total.reshape(len(g.nodes), tries, shape.width, shape.classes)
        else:
            total = np.moveaxis(total.reshape(3, len(g.nodes), tries, shape.width), 0, -1)
        known = [None] * len(g.nodes) if g.known is None else list(zip(*g.known, strict=True))
        found = [
            (t, node, *best_split(shape, sums, tried, told))
            for node, sums, tried, told in zip(g.nodes, total, g.tried, known, strict=True)
        ]
        kinds = [pa.int32()] * 4 + [pa.list_(pa.int32())] + [pa.float64()] * 2 + [pa.list_(pa.float64())] * 3 + [pa.float64()] * 2
        names = [field.split()[0] for field in SPLITS.replace(", ", ",").split(",")]
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    return choose


# --- the forest


class Tree:
    """Nodes by number: 1 is the root, 2n and 2n + 1 are the children of n."""

    def __init__(self, depth: int, width: int) -> None:
        size = 2 ** (depth + 1)
        self.feature, self.inner = np.zeros(size, np.int64), np.zeros(size, bool)
        self.left = np.zeros((size, width), bool)
        self.split: dict[int, tuple[int, list[float], int]] = {}
        # Gain, impurity (-1 if no split was allowed) and stats by node.
        self.told: dict[int, tuple[float, float, list[float]]] = {}

    def packed(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, whether nodes are split and a bit a bin, of the nodes down to ``depth``."""
        size = 2 ** (depth + 1)
        return self.feature[:size].astype(np.int16), self.inner[:size].copy(), np.packbits(self.left[:size], axis=1)


def _next_group(waiting: list[tuple[int, int]], shape: Shape, rng: JavaRandom, room: int) -> dict[int, list[tuple[int, list[int]]]]:
    """Nodes to split in the next pass, by tree: the last ones waiting, as far as their sums fit ``room`` bytes."""
    group: dict[int, list[tuple[int, list[int]]]] = {}
    used = 0
    while waiting:
        t, node = waiting[-1]
        tried = list(range(shape.features))
        if shape.per_node != shape.features:
            tried = reservoir(shape.features, shape.per_node, rng.next_long())
        need = shape.node_bytes(tried)
        if used and used + need > room:
            break
        waiting.pop()
        group.setdefault(t, []).append((node, tried))
        used += need
    return group


def _take(tree: Tree, shape: Shape, row, depth: int) -> list[int]:
    """Enter the best split of a node into its tree; children that are to be split in turn."""
    node, level = row.node, row.node.bit_length() - 1
    tree.told[node] = (row.gain, -1.0 if row.gain == INVALID else row.impurity, row.stats)
    if row.gain <= 0 or level == depth:
        return []
    f = row.feature
    tree.feature[node], tree.inner[node] = f, True
    if f in shape.arity:
        tree.left[node, row.categories] = True
        tree.split[node] = (f, [float(c) for c in row.categories], shape.arity[f] if shape.arity[f] > 1 else shape.bins[f])
    else:
        tree.left[node, : row.at + 1] = True
        tree.split[node] = (f, [float(shape.thresholds[f][row.at])], -1)
    sides = ((2 * node, row.left, row.left_impurity), (2 * node + 1, row.right, row.right_impurity))
    for child, stats, impurity in sides:
        tree.told[child] = (0.0, impurity, stats)
    return [child for child, _, impurity in sides if level + 1 < depth and abs(impurity) >= EPSILON]


def _pruned(tree: Tree, shape: Shape, node: int = 1) -> bool:
    """Make leaves side by side that predict the same one leaf, from below; whether ``node`` is a leaf then."""
    if not tree.inner[node]:
        return True
    leaves = [_pruned(tree, shape, child) for child in (2 * node, 2 * node + 1)]
    if all(leaves) and len({predicted(shape, tree.told[child][2]) for child in (2 * node, 2 * node + 1)}) == 1:
        tree.inner[node] = False
        return True
    return False


def _node_rows(tree: Tree, shape: Shape) -> list[tuple]:
    """Nodes in the order of Spark's model files."""
    rows: list[tuple] = []

    def listed(node: int) -> int:
        own = len(rows)
        rows.append(())
        gain, impurity, stats = tree.told[node]
        children, split = [-1, -1], (-1, [], -1)
        if tree.inner[node]:
            children, split = [listed(2 * node), listed(2 * node + 1)], tree.split[node]
        else:
            gain = -1.0
        count = int(sum(stats) if shape.classes else stats[0])
        rows[own] = (own, predicted(shape, stats), impurity, stats, count, gain, *children, split)
        return own

    listed(1)
    return rows


class PackedForest(Transformer):
    """A grown forest; adds the prediction that Spark's model of the same trees gives for a vector of features."""

    def __init__(self, forest: RandomForestClassifier | RandomForestRegressor, shape: Shape, trees: list[Tree]) -> None:
        super().__init__()
        self.forest, self.shape, self.trees = forest, shape, trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        predict = F.arrow_udf(_predictions_of(self.shape, self.trees), "double")
        values = vector_to_array(self.forest.getFeaturesCol())
        return dataset.withColumn(self.forest.getPredictionCol(), predict(values))

    def spark_model(self, spark: SparkSession) -> RandomForestClassificationModel | RandomForestRegressionModel:
        """The same trees as a model of Spark, which can be saved and gives votes and probabilities as well."""
        return _model(self.forest, spark, self.shape, self.trees)


def _predictions_of(shape: Shape, trees: list[Tree]):
    """Function for ``arrow_udf``: predictions for arrays of features, summed over the trees in their order."""
    parts = []
    for tree in trees:
        values = np.zeros((len(tree.inner), shape.classes or 1))
        for node, (_, _, stats) in tree.told.items():
            total = sum(stats) if shape.classes else 1.0
            if total:
                values[node] = np.array(stats) / total if shape.classes else predicted(shape, stats)
        last = max((node for node in tree.split if tree.inner[node]), default=0)
        steps = last.bit_length()
        splits = tree.packed(steps)
        parts.append((steps, splits, values[: len(splits[0])]))
    ready: list[tuple] = []

    def predict(features: pa.Array) -> pa.Array:
        if not ready:  # once a task
            ready.extend((steps, *unpacked(splits, shape.width), values) for steps, splits, values in parts)
        n = len(features)
        bins = binned(shape, features.flatten().to_numpy(zero_copy_only=False).reshape(n, shape.features)).ravel()
        starts, total = np.arange(n) * shape.features, np.zeros((n, shape.classes or 1))
        for steps, feature, ways, values in ready:
            node = _walked(np.ones(n, np.int64), steps, feature, ways, bins, starts, shape.width)
            total += values.take(node, axis=0)
        return pa.array(total.argmax(axis=1).astype(np.float64) if shape.classes else total[:, 0] / len(ready))

    return predict


def _model(forest: RandomForestClassifier | RandomForestRegressor, spark: SparkSession, shape: Shape, trees: list[Tree]):
    """Spark's model of the trees, by way of its file format."""
    kind = "Classification" if shape.classes else "Regression"
    package = f"org.apache.spark.ml.{kind.lower()}"
    common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    told = {p.name: v for p, v in forest._paramMap.items()}
    defaults = {p.name: v for p, v in forest._defaultParamMap.items()} | {"impurity": forest.getImpurity()}
    about = common | {
        "class": f"{package}.RandomForest{kind}Model", "uid": forest.uid, "paramMap": told, "defaultParamMap": defaults,
        "numFeatures": shape.features, "numTrees": len(trees),
    }
    if shape.classes:
        about["numClasses"] = shape.classes
    path = scratch_dir(spark)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [
        common | {"class": f"{package}.DecisionTree{kind}Model", "uid": f"tree_{uuid.uuid4().hex}", "paramMap": {}, "defaultParamMap": {}}
        for _ in trees
    ]
    lines = [(i, json.dumps(m), 1.0) for i, m in enumerate(each)]
    spark.createDataFrame(lines, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, row) for i, tree in enumerate(trees) for row in _node_rows(tree, shape)]
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
    return (RandomForestClassificationModel if shape.classes else RandomForestRegressionModel).load(path)


def fit(
    forest: RandomForestClassifier | RandomForestRegressor, rows: DataFrame, classes: int = 0, storage: StorageLevel = StorageLevel.DISK_ONLY
) -> PackedForest:
    """The trees that ``forest.fit(rows)`` grows, with ``classes`` labels from 0 on, or of a regression.

    The order of ``rows`` within their partitions is part of the result, as it is there. Trees, depth, bins, seed, least
    rows and least gain of ``forest`` count; bags are drawn with replacement at the full rate, rows have no weights.
    """
    depth = forest.getMaxDepth()
    shape = shape_of(forest, rows, classes)
    trees = [Tree(depth, shape.width) for _ in range(forest.getNumTrees())]
    blocks = packed(rows, shape, forest.getLabelCol(), forest.getFeaturesCol(), len(trees), forest.getSeed()).persist(storage)
    parts, rng = rows.rdd.getNumPartitions(), JavaRandom(forest.getSeed())
    waiting = [(t, 1) for t in range(len(trees))]
    try:
        while waiting:
            group = _next_group(waiting, shape, rng, forest.getMaxMemoryInMB() * 2**20)
            growing, choosing = {}, {}
            for t, members in group.items():
                nodes, tried = [node for node, _ in members], np.array([tried for _, tried in members], np.int16)
                told = [trees[t].told[node] for node in nodes if node > 1]
                known = (np.array([x[2] for x in told]), np.array([x[1] for x in told])) if told else None
                growing[t] = Growing(trees[t].packed(max(nodes).bit_length() - 1), nodes, tried)
                choosing[t] = Choosing(nodes, tried, known)
            sums = blocks.mapInArrow(_sums_of(shape, growing), SUMS).repartition(min(parts, len(growing)), "tree")
            found = sums.groupBy("tree").applyInArrow(_splits_of(shape, choosing), SPLITS).collect()  # one row a node
            best = {(row.tree, row.node): row for row in found}
            for t in map_order(group):
                for node, _ in group[t]:
                    waiting += [(t, child) for child in _take(trees[t], shape, best[t, node], depth)]
    finally:
        blocks.unpersist()
    for tree in trees:
        _pruned(tree, shape)
    return PackedForest(forest, shape, trees)
