"""Quality: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.common import keep_in_batches, text_of
from daystrata.llm.hashed import BUCKETS, FIT_ROWS, Adam, Sample, drawn, held_out, in_slices, row_sums, rounds, sample_terms
from daystrata.llm.words import PLAIN, WordHashes

# Grades from which a document counts as good, and how sure that must be.
GOOD_GRADE = 1
TAIL = 0.5

# Letters as a and A, digits as 0; bytes that are not ASCII count as small letters.
SHAPES = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
REPEATS = re.compile(rb"(.)\1+", re.S)
# Shares are told apart at these steps.
STEPS = (0.0, 0.01, 0.05, 0.2, 0.5, 0.8)


def grade(quality: Column, toxic: Column) -> Column:
    """The graded rating: 0 for poor text, 1 for good text that is toxic, 2 for good text."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).when(quality == 1, 2).cast("double")


def terms_of_text(text: str | None, word_hashes: WordHashes) -> list[int]:
    """Distinct hashed terms: words, shapes of words by their share, and shares of repeated words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    found = {int(h) % BUCKETS for h in np.unique(word_hashes(text))}
    if words:
        n = len(words)
        shapes = Counter(REPEATS.sub(rb"\1", raw.translate(SHAPES)).split())
        marks = [(b"shape " + shape, count / n) for shape, count in shapes.items()]
        marks.append((b"distinct", len(set(words)) / n))
        marks.append((b"same as before", sum(map(bytes.__eq__, words[1:], words[:-1])) / n))
        marks.append((b"lines", min(1.0, raw.count(b"\n") / n)))
        marks.append((b"long", min(1.0, len(raw) / n / 40)))
        for name, share in marks:
            step = sum(share > s for s in STEPS)
            found.add(xxhash.xxh64_intdigest(name + b" %d" % step) % BUCKETS)
    return sorted(found)


def with_terms(rows: DataFrame) -> DataFrame:
    """``rows`` with ``buckets``, the hashed terms of the whole text."""
    schema = T.StructType([*(f for f in rows.schema if f.name != "text"), T.StructField("buckets", T.ArrayType(T.IntegerType()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes = WordHashes(PLAIN)
        for batch in in_slices(batches):
            buckets = [terms_of_text(t, word_hashes) for t in batch.column("text").to_pylist()]
            names = [n for n in batch.schema.names if n != "text"]
            columns = [batch.column(n) for n in names] + [pa.array(buckets, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "buckets"])

    return rows.mapInArrow(add, schema)


def fit(sample: Sample, grades: int, rate: float = 0.05, shrink: float = 1e-5, seed: int = 11) -> dict:
    """One weight per term and an ordered threshold below each grade but the first.

    P(grade >= k) is the logistic function of (sum of weights - threshold k); thresholds are a first one and positive
    gaps, so they stay in order.
    """
    model = {"weights": np.zeros(len(sample.buckets)), "first": np.array(0.0), "gaps": np.zeros(max(0, grades - 2))}
    adam = Adam(rate)
    for part in rounds(sample, seed):
        slopes = gradients(model, part, grades)
        slopes["weights"] = slopes["weights"] + shrink * model["weights"]
        adam.step(model, slopes)
    return model


def gradients(model: dict, sample: Sample, grades: int) -> dict[str, np.ndarray]:
    """Slopes of the mean log loss of the sample."""
    n = len(sample.labels)
    row = np.repeat(np.arange(n), np.diff(np.concatenate((sample.starts, [len(sample.terms)]))))
    grade_of, at = sample.labels.astype(int), np.arange(n)
    tails = _tails(model, row_sums(model["weights"][sample.terms], sample.starts))
    # Chance of the row's own grade: the tail from it on less the tail from the next one on.
    padded = np.concatenate((np.ones((n, 1)), tails, np.zeros((n, 1))), axis=1)
    slope = padded * (1 - padded)
    chance = np.maximum(padded[at, grade_of] - padded[at, grade_of + 1], 1e-9)
    own, following = slope[at, grade_of] / chance / n, slope[at, grade_of + 1] / chance / n
    to_sum = following - own
    to_threshold = np.zeros(grades + 1)
    np.add.at(to_threshold, grade_of, own)
    np.add.at(to_threshold, grade_of + 1, -following)
    by_threshold = to_threshold[1:grades]
    after = np.cumsum(by_threshold[::-1])[::-1]
    return {
        "weights": np.bincount(sample.terms, to_sum[row], len(sample.buckets)),
        "first": by_threshold.sum(),
        "gaps": after[1:] * np.exp(model["gaps"]),
    }


def _tails(model: dict, sums: np.ndarray) -> np.ndarray:
    thresholds = model["first"] + np.concatenate(([0.0], np.cumsum(np.exp(model["gaps"]))))
    return 1 / (1 + np.exp(-np.clip(sums[:, None] - thresholds[None, :], -30, 30)))


def _scorer(model: dict, buckets: np.ndarray):
    names = ["doc_id", "tails"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes = WordHashes(PLAIN)
        for batch in batches:
            terms = [np.array(terms_of_text(t, word_hashes), np.int64) for t in batch.column("text").to_pylist()]
            known = [np.searchsorted(buckets, t[np.isin(t, buckets, assume_unique=True)]) for t in terms]
            lengths = np.array([len(k) for k in known], np.int64)
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64) if len(known) else lengths
            flat = np.concatenate(known).astype(np.int64) if len(known) else lengths
            tails = _tails(model, row_sums(model["weights"][flat], starts)) if len(known) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(tails), pa.list_(pa.float64()))], names)

    return score


def score_quality(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    good_grade: int = GOOD_GRADE,
    tail: float = TAIL,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Per input row: doc_id, held_out, expected_grade, tail_probability (of ``good_grade`` or more) and kept.

    Grades are whole numbers from 0. The model is fitted on rated rows that are not held out, ``fit_rows`` of them at
    most (about). Null and empty texts have no terms; their grade follows from the thresholds alone. Ratings that are
    null or without id are not used; of several ratings of one id the largest counts. Without any rating every document
    is as likely good as not, and kept. Rows are scored one by one in a single pass: repeated rows get equal scores,
    and an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rated = ratings.select(F.col(id_col).alias("doc_id"), F.col(grade_col).cast("double").alias("label"))
    chosen = drawn(rated, fit_rows)
    grades = int(chosen.agg(F.max("label")).first()[0] or 0) + 1
    grades = max(2, grades, good_grade + 1)
    if chosen.isEmpty():
        model = {"weights": np.zeros(0), "first": np.array(0.0), "gaps": np.zeros(grades - 2)}
        buckets = np.zeros(0, np.int64)
    else:
        sample = sample_terms(rows, chosen, with_terms, fit_rows)
        model, buckets = fit(sample, grades), sample.buckets
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("tails", T.ArrayType(T.DoubleType()))])
    scored = keep_in_batches(rows.mapInArrow(_scorer(model, buckets), schema))
    good = F.element_at("tails", good_grade)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.aggregate("tails", F.lit(0.0), lambda total, x: total + x).alias("expected_grade"),
        good.alias("tail_probability"),
        (good >= tail).alias("kept"),
    )
