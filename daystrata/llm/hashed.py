"""Labelled samples of documents as hashed terms, for the classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.common import keep, keep_in_batches, small

# Buckets that terms are hashed to.
BUCKETS = 1 << 20
# Labelled rows that a model is fitted on at most (about: each is drawn by a hash of its id).
FIT_ROWS = 30_000
# Rows of these in which pairs of near words are counted as well, at most (about).
PAIR_ROWS = 2_000
# A fit goes over all rows this often, a part of them at each step, and makes this many steps at least.
ROUNDS = 8
PART_ROWS = 512
LEAST_STEPS = 300
# Texts that are turned into terms together.
SLICE_ROWS = 256
# A term in fewer documents of the sample than this tells nothing.
LEAST_DOCUMENTS = 5
# Squared standard errors by which a term's documents must differ from all; less is likely chance among so many terms.
LEAST_WORTH = 25.0


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: those whose crc32 of the id as text leaves 1 when divided by 3."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1


@dataclass
class Sample:
    """Fitting rows: their labels, and the terms of each (indices into ``buckets``), flat with a start per row."""

    buckets: np.ndarray
    labels: np.ndarray
    terms: np.ndarray
    starts: np.ndarray


def drawn(labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, label) of about ``fit_rows`` labelled rows at most, one per id, none held out. A kept table."""
    usable = labels.select("doc_id", "label").dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    usable = keep(usable)
    share = min(1.0, fit_rows / max(1, usable.count()))
    return keep(usable.filter(F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 32) < share * 2.0**32))


def sample_terms(rows: DataFrame, chosen: DataFrame, terms_of, fit_rows: int = FIT_ROWS, pair_rows: int = 0) -> Sample:
    """The drawn rows with every term that tells something about the label, alone or in company.

    ``terms_of`` turns rows (doc_id, text, ...) into rows with ``buckets``, an array of distinct hashed terms; with
    ``pair_rows`` it sees a column ``paired`` and also gives ``pairs``, an array of distinct codes (first bucket *
    BUCKETS + second bucket) of words that stand near each other, for about so many rows. A term's worth is the squared
    distance of its documents' labels from the mean of all, over its standard error; a pair's worth is the distance
    from what its two terms say added up. Terms of worth stay, however many, and both terms of pairs of worth. What
    comes to the driver is bounded by the terms of ``fit_rows`` rows.
    """
    if pair_rows:
        share = min(1.0, pair_rows / max(1, chosen.count()))
        chosen = chosen.withColumn("paired", F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 32) < share * 2.0**32)
    met = terms_of(rows.join(small(chosen, 2 * fit_rows), "doc_id"))
    arrays = [F.min(name).alias(name) for name in ("buckets", "pairs") if name in met.columns]
    met = keep_in_batches(met.groupBy("doc_id").agg(F.max("label").alias("label"), *arrays))
    n, mean, var = met.agg(F.count("*"), F.avg("label"), F.var_pop("label")).first()
    if not n or not var:
        label = float(mean or 0.0)
        return Sample(np.zeros(0, np.int64), np.full(max(1, n), label), np.zeros(0, np.int64), np.zeros(max(1, n), np.int64))
    each = keep(_counted(met, "buckets", "bucket"))
    telling = each.filter(_worth(F.lit(mean), F.lit(var)) >= LEAST_WORTH).select("bucket")
    if pair_rows:
        telling = telling.unionByName(_in_company(_counted(met, "pairs", "pair"), each, mean, var)).distinct()
    telling = keep(telling)
    buckets = np.sort(telling.toArrow().column("bucket").to_numpy()).astype(np.int64)
    told = keep_in_batches(_places(met.select("doc_id", "label", "buckets"), buckets))
    told = told.toArrow().to_pandas().sort_values("doc_id")
    lengths = told["places"].map(len).to_numpy(np.int64)
    row = np.repeat(np.arange(len(told)), lengths)
    term = np.concatenate([np.zeros(0, np.int64), *told["places"]])
    order = np.lexsort((term, row))
    starts = np.searchsorted(row[order], np.arange(len(told)))
    return Sample(buckets, told["label"].to_numpy(float), term[order].astype(np.int64), starts.astype(np.int64))


def _places(met: DataFrame, buckets: np.ndarray) -> DataFrame:
    """``met`` with ``places`` instead of ``buckets``: where each row's buckets stand in the sorted ``buckets``, if they do.

    A row stays one row, however many rows share a bucket.
    """
    kept = [f for f in met.schema if f.name != "buckets"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int64)
        place[buckets] = np.arange(len(buckets))
        for batch in in_slices(batches):
            own = [place[b] for b in batch.column("buckets").to_numpy(zero_copy_only=False)]
            places = pa.array([b[b >= 0] for b in own], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), places], [*(f.name for f in kept), "places"])

    return met.mapInArrow(found, T.StructType([*kept, T.StructField("places", T.ArrayType(T.LongType()))]))


def _counted(met: DataFrame, name: str, alias: str) -> DataFrame:
    """(alias, n, s): documents and sum of labels of every value in arrays; values in few documents are left out."""
    values = met.select("label", F.explode(name).alias(alias))
    return values.groupBy(alias).agg(F.count("*").alias("n"), F.sum("label").alias("s")).filter(F.col("n") >= LEAST_DOCUMENTS)


def _worth(expected: Column, var: Column) -> Column:
    return F.pow(F.col("s") - F.col("n") * expected, 2) / (F.col("n") * var)


def _in_company(pairs: DataFrame, each: DataFrame, mean: float, var: float) -> DataFrame:
    """Both buckets of every pair whose documents' labels differ from what its terms say one by one, added up."""
    pairs = pairs.filter(_worth(F.lit(mean), F.lit(var)) >= LEAST_WORTH)
    pairs = pairs.withColumns({"a": F.expr(f"pair div {BUCKETS}").cast("int"), "b": (F.col("pair") % BUCKETS).cast("int")})
    for name in ("a", "b"):
        pairs = pairs.join(each.select(F.col("bucket").alias(name), (F.col("s") / F.col("n")).alias(f"rate_{name}")), name)
    expected = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("rate_a") + F.col("rate_b") - mean))
    spread = F.greatest(F.lit(var), expected * (1 - expected))
    return pairs.filter(_worth(expected, spread) >= LEAST_WORTH).select(F.explode(F.array("a", "b")).alias("bucket"))


def rounds(sample: Sample, seed: int) -> Iterator[Sample]:
    """Parts of the sample in a seeded order, all rows once in each round."""
    random, n = np.random.default_rng(seed), len(sample.labels)
    lengths = np.diff(np.concatenate((sample.starts, [len(sample.terms)])))
    parts = -(-n // PART_ROWS)
    for _ in range(max(ROUNDS, -(-LEAST_STEPS // parts))):
        for rows in np.array_split(random.permutation(n) if parts > 1 else np.arange(n), parts):
            size = lengths[rows]
            ends = np.cumsum(size)
            places = np.arange(int(size.sum())) + np.repeat(sample.starts[rows] - (ends - size), size)
            yield Sample(sample.buckets, sample.labels[rows], sample.terms[places], ends - size)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what is made of long texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` from each start to the next, each for itself; rows may have no values."""
    result = np.zeros((len(starts), *values.shape[1:]))
    some = np.diff(np.concatenate((starts, [len(values)]))) > 0
    if some.any():
        result[some] = np.add.reduceat(values, starts[some], axis=0)
    return result


class Adam:
    """Steps of the Adam rule for a dict of arrays."""

    def __init__(self, rate: float):
        self.rate, self.steps, self.mean, self.square = rate, 0, {}, {}

    def step(self, parameters: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, gradient in gradients.items():
            self.mean[name] = 0.9 * self.mean.get(name, 0.0) + 0.1 * gradient
            self.square[name] = 0.999 * self.square.get(name, 0.0) + 0.001 * gradient * gradient
            mean = self.mean[name] / (1 - 0.9**self.steps)
            square = self.square[name] / (1 - 0.999**self.steps)
            parameters[name] -= self.rate * mean / (np.sqrt(square) + 1e-8)
