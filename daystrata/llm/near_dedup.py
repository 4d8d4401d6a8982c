"""Near duplicates: MinHash bands propose pairs, odd sketches weed them out, full shingle sets confirm them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import keep, keep_in_batches, small, text_of
from daystrata.llm.components import components
from daystrata.llm.words import LOWER, MIX, WordHashes, mixed, runs

SHINGLE_WORDS = 5
# A link: 100 * common shingles >= PERCENT * all shingles of the two sets.
PERCENT = 80
BROADCAST_IDS = 200_000
# Rounds in which open bands try the member with most links.
PIVOTS = 3


@dataclass(frozen=True)
class Signer:
    """MinHash samples of shingle sets, cut into bands, and odd sketches.

    A pair with similarity s shares no band with probability (1 - s ** rows) ** bands: with 40 bands of 5 rows one in
    eight million pairs at 0.8, fewer above. The sketch is a bitmap in which every sample of one permutation, the
    smallest hash in each of ``bins`` ranges, flips one bit; bits that differ between two sketches count samples that
    differ. Small sets are sampled almost whole, so the count is sharp for them.
    """

    words: int = SHINGLE_WORDS
    bands: int = 40
    rows: int = 5
    bins: int = 65_536
    bits: int = 4_096
    seed: int = 7

    def __post_init__(self):
        random = np.random.default_rng(self.seed)
        samples = self.bands * self.rows
        object.__setattr__(self, "factors", random.integers(1, 2**63, samples, np.uint64) * np.uint64(2) + np.uint64(1))
        object.__setattr__(self, "shifts", random.integers(0, 2**63, samples, np.uint64))

    def most_bits(self, sizes: Column, percent: int, sigmas: float = 5.0) -> Column:
        """Bits by which the sketches of a linked pair differ at most, but for chance beyond ``sigmas``.

        ``sizes`` is the number of shingles of both sets together. Of u different shingles, u / bins fall into a bin.
        Where the smallest one of a bin is not common, it is a differing sample, and so is the other set's smallest,
        if it has one there. Bins with several shingles make the count vary, as do samples that meet on a bit.
        """
        like = percent / 100
        load = sizes / (1 + like) / self.bins
        half = (1 + like) / 2
        empty = F.exp(-load)
        expected = (2 * (1 - empty) - (F.exp(-load * half) - empty) / (1 - half)) * (self.bins * (1 - like))
        several = (1 - empty * (1 + load)) * self.bins
        most = expected + F.sqrt(F.greatest(several, F.lit(0.0))) * sigmas + 2
        flipped = (1 - F.exp(most * (-2 / self.bits))) * (self.bits / 2)
        return flipped + F.least(most * math.sqrt(2 / self.bits), F.lit(math.sqrt(self.bits) / 2)) * sigmas + 1

    def shingles(self, hashes: np.ndarray) -> np.ndarray:
        """The distinct shingles of a text's words; a shorter text is one shingle."""
        if not len(hashes):
            return hashes
        return np.unique(runs(hashes, min(self.words, len(hashes))))

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        lowest = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(shingles), 2048):
            values = np.multiply.outer(self.factors, shingles[i : i + 2048])
            values += self.shifts[:, None]
            np.minimum(lowest, values.min(axis=1), out=lowest)
        return lowest

    def keys(self, samples: np.ndarray) -> np.ndarray:
        """One key per band, different for different bands."""
        by_band = samples.reshape(self.bands, self.rows)
        key = mixed(np.arange(self.bands, dtype=np.uint64))
        for row in range(self.rows):
            key = mixed(key ^ by_band[:, row])
        return key.view(np.int64)

    def sketch(self, shingles: np.ndarray) -> np.ndarray:
        """The parity of the samples that fall on each bit, as 64-bit words; ``shingles`` are sorted."""
        _, first = np.unique(shingles // np.uint64(2**64 // self.bins), return_index=True)
        bit = mixed(shingles[first] ^ MIX) % np.uint64(self.bits)
        odd = np.bincount(bit.astype(np.int64), minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("digest", pa.binary()),
        ("keys", pa.list_(pa.int64())),
        ("sketch", pa.list_(pa.int64())),
    ]
)


def _signed(signer: Signer):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes = WordHashes(LOWER)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                shingles = signer.shingles(word_hashes(text))
                if not len(shingles):
                    rows.append((doc_id, 0, None, None, None))
                    continue
                samples = signer.samples(shingles)
                digest = xxhash.xxh128_digest(shingles.tobytes())
                rows.append((doc_id, len(shingles), digest, signer.keys(samples), signer.sketch(shingles)))
            columns = list(zip(*rows)) or [()] * len(SIGNED)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SIGNED)], schema=SIGNED)

    return sign


def _confirmed(words: int, percent: int):
    """Whether two texts are linked, by their full sets. Rows come in the order of the first text's document."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes, signer = WordHashes(LOWER), Signer(words=words)
        for batch in batches:
            linked, last, of_last = [], None, None
            for left, right in zip(batch.column("left_text").to_pylist(), batch.column("right_text").to_pylist()):
                if left != last:
                    last, of_last = left, signer.shingles(word_hashes(left))
                other = signer.shingles(word_hashes(right))
                common = len(np.intersect1d(of_last, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(of_last) + len(other) - common))
            chosen = batch.select(["left", "right"]).filter(pa.array(linked, pa.bool_()))
            yield chosen

    return confirm


def _differing_bits(left: str, right: str) -> Column:
    each = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(each, F.lit(0), lambda total, bits: total + bits)


class NearDuplicates:
    """The steps of ``near_duplicates`` over one table."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, signer: Signer, percent: int):
        self.signer, self.percent = signer, percent
        self.rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
        schema = "doc_id long, n_shingles long, digest binary, keys array<long>, sketch array<long>"
        self.signed = keep_in_batches(self.rows.mapInArrow(_signed(signer), schema))
        known = self.signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
        self.classes = keep(known.groupBy("digest").agg(F.min("doc_id").alias("rep")))
        # One row per different set: that of its first document.
        firsts = known.join(self.classes, (known.digest == self.classes.digest) & (F.col("doc_id") == F.col("rep")), "left_semi")
        self.sets = keep(firsts.dropDuplicates(["digest"]).select(F.col("doc_id").alias("rep"), "keys", "sketch", "n_shingles"))

    def members(self) -> DataFrame:
        """(key, rep) of every band shared by at least two sets."""
        each = self.sets.select(F.explode("keys").alias("key"), "rep")
        shared = each.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).filter("n > 1")
        return keep(each.join(shared, "key"))

    def sketched(self, side: str) -> DataFrame:
        return self.sets.select(
            F.col("rep").alias(side), F.col("sketch").alias(f"{side}_sketch"), F.col("n_shingles").alias(f"{side}_size")
        )

    def close(self) -> Column:
        """Whether the sizes and sketches of left and right allow a link."""
        least, most = F.least("left_size", "right_size"), F.greatest("left_size", "right_size")
        bits = self.signer.most_bits(F.col("left_size") + F.col("right_size"), self.percent)
        return (100 * least >= self.percent * most) & (_differing_bits("left_sketch", "right_sketch") <= bits)

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (left, right) whose sketches are close, smaller id first."""
        pairs = pairs.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()
        joined = pairs.join(self.sketched("left"), "left").join(self.sketched("right"), "right")
        return keep(joined.filter(self.close()).select("left", "right"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are linked by their full sets. Only texts that are in a pair are shuffled."""
        ids = keep(pairs.select(F.explode(F.array("left", "right")).alias("doc_id")).distinct())
        texts = self.rows.join(small(ids, BROADCAST_IDS), "doc_id", "left_semi")
        left = texts.select(F.col("doc_id").alias("left"), F.col("text").alias("left_text"))
        right = texts.select(F.col("doc_id").alias("right"), F.col("text").alias("right_text"))
        both = pairs.join(right, "right").join(left, "left").select("left", "right", "left_text", "right_text")
        return keep_in_batches(both.mapInArrow(_confirmed(self.signer.words, self.percent), "left long, right long"))

    def open_bands(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """(key, rep, head, component, largest) of the bands whose members are in several components."""
        labelled = members.filter("n > 2").join(found, members.rep == found.node, "left")
        labelled = keep(labelled.select("key", "rep", "head", F.coalesce("component", "rep").alias("component")))
        sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"))
        return keep(labelled.join(largest.filter("parts > 1").select("key", "largest"), "key"))

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Confirmed links and the components (node, component) they make.

        First every member of a band is held against the band's smallest id, then ``PIVOTS`` times against the member
        with most links so far, as long as that joins components; a band whose members are in one component can add
        nothing. In the bands left, members outside the largest component are held against all members of other
        components, and whoever sizes or sketches tell apart is not passed on. So copies by the thousand cost a few
        pairs each, and no link between components is missed.
        """
        members = self.members()
        stars = members.filter("head <> rep").select(F.col("head").alias("left"), F.col("rep").alias("right"))
        links = self.confirmed(self.alike(stars))
        found = components(links)
        open_ = self.open_bands(members, found)
        left, before = open_.count(), None
        for _ in range(PIVOTS):
            # A round that closes less than a tenth of what is open is not worth another one.
            if not left or (before is not None and left > 0.9 * before):
                break
            more = self.confirmed(self.alike(self.pivoted(open_, links)))
            if more.isEmpty():
                break
            links = keep(links.unionByName(more).distinct())
            found = components(links)
            open_ = self.open_bands(members, found)
            left, before = open_.count(), left
        if not left:
            return links, found
        more = self.confirmed(keep(self.across(open_)))
        links = keep(links.unionByName(more).distinct())
        return links, components(links)

    def pivoted(self, open_: DataFrame, links: DataFrame) -> DataFrame:
        """(left, right): in each open band, the member with most links and those of other components than its own."""
        degree = links.select(F.explode(F.array("left", "right")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
        ranked = open_.join(degree, F.col("rep") == F.col("node"), "left")
        best = F.struct(F.coalesce("degree", F.lit(0)), -F.col("rep"))
        pivots = ranked.groupBy("key").agg(F.max_by(F.struct("rep", "component"), best).alias("pivot"))
        met = open_.join(pivots, "key").filter(F.col("component") != F.col("pivot.component"))
        return met.select(F.col("pivot.rep").alias("left"), F.col("rep").alias("right"))

    def across(self, open_: DataFrame) -> DataFrame:
        """Close pairs (left, right) of members of a band that are in different components."""
        few = open_.filter("component <> largest").select(
            F.col("key").alias("few_key"), F.col("rep").alias("left"), F.col("component").alias("left_component")
        )
        every = open_.select("key", "head", F.col("rep").alias("right"), F.col("component").alias("right_component"), "largest")
        untried = (
            (F.col("left_component") != F.col("right_component"))
            # Of two outside the largest component, one direction is enough; heads have been tried with everyone.
            & ((F.col("right_component") == F.col("largest")) | (F.col("left") < F.col("right")))
            & (F.col("left") != F.col("head"))
            & (F.col("right") != F.col("head"))
        )
        few = few.join(self.sketched("left"), "left").join(self.sets.select(F.col("rep").alias("left"), F.col("keys").alias("left_keys")), "left")
        every = every.join(self.sketched("right"), "right").join(
            self.sets.select(F.col("rep").alias("right"), F.col("keys").alias("right_keys")), "right"
        )
        # A pair that shares several bands is passed on in one of them only.
        once = F.array_min(F.array_intersect("left_keys", "right_keys")) == F.col("key")
        pairs = few.join(every, (F.col("few_key") == F.col("key")) & untried & self.close() & once)
        return pairs.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    signer: Signer | None = None,
    percent: int = PERCENT,
) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id, kept, n_links (links of its set to other sets).

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a document's set has its distinct runs of
    ``signer.words`` words, or the whole text as one run if it is shorter. Documents with equal sets are one class and
    only the class takes part in the search. ``component_id`` is the smallest id reachable over links.

    Null texts and texts without words have an empty set and are linked with nothing: their component is their id.
    Rows without an id are counted but linked with nothing; they have no component and are kept. Rows that repeat an
    id are one document: what any of its texts is linked with is linked. An empty table gives an empty result.
    """
    steps = NearDuplicates(docs, id_col, text_col, signer or Signer(), percent)
    links, found = steps.links()
    degree = links.select(F.explode(F.array("left", "right")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    classes = steps.classes.join(found, F.col("rep") == F.col("node"), "left").drop("node").join(degree, F.col("rep") == F.col("node"), "left")
    classes = classes.select("digest", F.coalesce("component", "rep").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = steps.signed.select("doc_id", "n_shingles", "digest")
    answers = rows.join(keep(classes), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return answers.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (component.isNull() | (component == F.col("doc_id"))).alias("kept"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
