"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.common import keep_in_batches, text_of
from daystrata.llm.hashed import BUCKETS, FIT_ROWS, PAIR_ROWS, Adam, Sample, drawn, held_out, in_slices, row_sums, rounds, sample_terms
from daystrata.llm.words import MULTIPLIER, PLAIN, mixed

FACTORS = 8
THRESHOLD = 0.7
# Characters of a word's beginnings that are terms of their own.
BEGINNINGS = (4, 5, 6)
# Words after a word that it makes pairs with, where pairs are counted.
NEAR_WORDS = 5
# Texts scored together.
TEXTS = 64


class Terms:
    """Distinct hashed terms of whole texts: lower-case words and their beginnings.

    Languages that compound words say the same thing in ever new words, so beginnings count too, and once more if two
    or three words of the text begin so. Words already seen are looked up.
    """

    def __init__(self, limit: int = 100_000):
        self.limit = limit
        self.known: dict[str, tuple[int, ...]] = {}

    def words(self, text: str | None) -> list[str]:
        """Words in order: ASCII letters and digits and whatever is not ASCII."""
        raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(PLAIN)
        return raw.decode("utf-8", "surrogatepass").split(" ")

    def _look(self, words: set[str]) -> None:
        if len(self.known) > self.limit:
            self.known.clear()
        for word in words.difference(self.known):
            names = [word, *(f"{n} {word[:n]}" for n in BEGINNINGS)]
            self.known[word] = tuple(xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct buckets."""
        words = set(self.words(text))
        words.discard("")
        self._look(words)
        each = np.fromiter(chain.from_iterable(map(self.known.__getitem__, words)), np.int64, (1 + len(BEGINNINGS)) * len(words))
        each.sort()
        again = [_hashed(each[n:][each[n:] == each[:-n]], n) for n in (1, 2)]
        return np.unique(np.concatenate((each, *again)))

    def pairs(self, text: str | None) -> np.ndarray:
        """Distinct codes of the buckets of words at most NEAR_WORDS apart, the smaller bucket first."""
        words = [w for w in self.words(text) if w]
        self._look(set(words))
        each = np.fromiter((self.known[w][0] for w in words), np.int64, len(words))
        near = [(each[:-n], each[n:]) for n in range(1, NEAR_WORDS + 1) if n < len(each)]
        codes = [np.minimum(a, b) * BUCKETS + np.maximum(a, b) for a, b in near]
        return np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)


def _hashed(buckets: np.ndarray, n: int) -> np.ndarray:
    return (mixed(buckets.astype(np.uint64) * MULTIPLIER + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64)


def with_terms(rows: DataFrame) -> DataFrame:
    """``rows`` (text, paired, ...) without text and paired, with ``buckets`` and ``pairs``; only some have pairs."""
    kept = [f for f in rows.schema if f.name not in ("text", "paired")]
    more = [T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("pairs", T.ArrayType(T.LongType()))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in in_slices(batches):
            texts, paired = batch.column("text").to_pylist(), batch.column("paired").to_pylist()
            buckets = pa.array([terms(t) for t in texts], pa.list_(pa.int32()))
            pairs = pa.array([terms.pairs(t) if p else None for t, p in zip(texts, paired)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), buckets, pairs], [*(f.name for f in kept), "buckets", "pairs"])

    return rows.mapInArrow(add, T.StructType(kept + more))


def fit(sample: Sample, factors: int = FACTORS, rate: float = 0.05, shrink: float = 1e-5, seed: int = 11) -> dict:
    """Weights of a factorization machine by gradient steps over parts of the sample in turn.

    The score of a document with terms i is the logistic function of bias + sum of w_i + sum over pairs of v_i . v_j.
    """
    random = np.random.default_rng(seed)
    rate_of_ones = np.clip(sample.labels.mean(), 1e-4, 1 - 1e-4)
    model = {
        "bias": np.array(np.log(rate_of_ones / (1 - rate_of_ones))),
        "linear": np.zeros(len(sample.buckets)),
        "pairs": random.normal(0, 0.02, (len(sample.buckets), factors)),
    }
    if not len(sample.buckets):
        return model
    adam = Adam(rate)
    for part in rounds(sample, seed):
        slopes = gradients(model, part)
        slopes["linear"] = slopes["linear"] + shrink * model["linear"]
        slopes["pairs"] = slopes["pairs"] + shrink * model["pairs"]
        adam.step(model, slopes)
    return model


def gradients(model: dict, sample: Sample) -> dict[str, np.ndarray]:
    """Slopes of the mean log loss of the sample."""
    n, size = len(sample.labels), len(sample.buckets)
    row = np.repeat(np.arange(n), np.diff(np.concatenate((sample.starts, [len(sample.terms)]))))
    logits, sums = _logits(model, sample.terms, sample.starts)
    error = (1 / (1 + np.exp(-logits)) - sample.labels) / n
    by_term = error[row]
    pull = by_term[:, None] * (sums[row] - model["pairs"][sample.terms])
    return {
        "bias": error.sum(),
        "linear": np.bincount(sample.terms, by_term, size),
        "pairs": np.stack([np.bincount(sample.terms, pull[:, f], size) for f in range(pull.shape[1])], 1),
    }


def _logits(model: dict, terms: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = model["pairs"][terms]
    sums = row_sums(own, starts)
    squares = row_sums(own * own, starts)
    linear = row_sums(model["linear"][terms], starts)
    return np.clip(model["bias"] + linear + 0.5 * (sums * sums - squares).sum(axis=1), -30, 30), sums


def scores(model: dict, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-_logits(model, terms, starts)[0]))


def with_score(rows: DataFrame, model: dict, buckets: np.ndarray) -> DataFrame:
    """``rows`` (text, ...) without the text, with the score of each whole text, from one pass: a kept table.

    It is kept so that batches of long texts stay small, and that no filter has scores worked out again.
    """

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        place = np.full(BUCKETS, -1, np.int64)
        place[buckets] = np.arange(len(buckets))
        for texts in batches:
            yield pd.Series(np.concatenate([np.zeros(0), *(some(texts[i : i + TEXTS], terms, place) for i in range(0, len(texts), TEXTS))]))

    def some(texts: pd.Series, terms: Terms, place: np.ndarray) -> np.ndarray:
        found = [place[terms(text)] for text in texts]
        found = [f[f >= 0] for f in found]
        starts = np.cumsum([0, *(len(f) for f in found[:-1])]).astype(np.int64)
        return scores(model, np.concatenate(found), starts)

    return keep_in_batches(rows.withColumn("score", F.pandas_udf(scored, "double")("text")).drop("text"))


def learnt(rows: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, pair_rows: int = PAIR_ROWS) -> tuple[dict, np.ndarray]:
    """Model and buckets from ``rows`` (doc_id, text) and ``labels`` (doc_id, label)."""
    labelled = labels.withColumn("label", F.col("label").cast("double"))
    sample = sample_terms(rows, drawn(labelled, fit_rows), with_terms, fit_rows, pair_rows)
    return fit(sample), sample.buckets


def without_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs``, whole rows, whose score is below ``threshold``; the model is that of ``score_toxicity``."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    model, buckets = learnt(rows.drop("doc"), labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")))
    return with_score(rows, model, buckets).filter(F.col("score") < threshold).select("doc.*")


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    fit_rows: int = FIT_ROWS,
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """Per input row: doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    The model is fitted on labelled rows that are not held out, ``fit_rows`` of them at most (about), over all terms
    that tell something about the label in these rows, alone or next to another (``pair_rows`` of the rows); labels,
    language, source and id are no inputs of a score. Null and empty texts have no terms and get the score of the bias. Labels
    that are null or without id are not used; of several labels of one id the largest counts. Without any label every
    score is that of a rate of zero. Rows are scored one by one in a single pass: repeated rows get equal scores, and
    an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    model, buckets = learnt(rows, labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")), fit_rows, pair_rows)
    return with_score(rows, model, buckets).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
