"""Benchmark decontamination: spaced seeds find places, aligned words around them are compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import keep_in_batches, text_of
from daystrata.llm.words import PLAIN, WordHashes, picked

# Places that a mask looks at. Of any 20 aligned words of which at least 16 are equal, one of the masks finds some
# place where all of its words are (a test tries every pattern).
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 5, 6), (0, 1, 2, 4, 8, 9))
# The same for shorter items: (words, unequal words, masks) of which one is always whole, also in longer runs and with
# fewer unequal words.
FAMILIES = (
    (20, 4, MASKS),
    (15, 3, ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8))),
    (10, 2, ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4))),
    (5, 1, ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))),
)
WINDOW = 20
SHARE = 0.8
# Places of the table that is looked at before the sorted seeds; a power of two.
FILTER = 1 << 22
# Benchmark words that one pass over the documents looks for; a larger benchmark takes more passes.
BLOCK_WORDS = 500_000


def least_equal(length: int, share: float) -> int:
    """How many of ``length`` words have to be equal."""
    return max(1, int(np.ceil(share * length - 1e-9)))


def masks_for(length: int, unequal: int) -> tuple[tuple[int, ...], ...]:
    """Masks of which one is whole somewhere in ``length`` words whichever ``unequal`` of them differ."""
    for words, most, masks in FAMILIES:
        if length >= words and unequal <= most:
            return masks
    # Some run between the unequal words is as long as this.
    return (tuple(range(max(1, length // (unequal + 1)))),)


class Items:
    """Benchmark items with the hashes of their seeds."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW, share: float = SHARE):
        self.window, self.share = window, share
        word_hashes = WordHashes(PLAIN)
        self.ids = [i for i, _ in items]
        self.words = [word_hashes(text) for _, text in items]
        looked_for: dict[tuple[int, ...], list[int]] = {}
        for item, words in enumerate(self.words):
            length = min(window, len(words))
            for mask in masks_for(length, length - least_equal(length, share)) if length else ():
                looked_for.setdefault(mask, []).append(item)
        self.seeds = []
        for mask, having in looked_for.items():
            found = [(seed, item, place) for item in having for place, seed in enumerate(picked(self.words[item], mask))]
            found.sort()
            self.seeds.append(
                (
                    mask,
                    np.array([f[0] for f in found], np.uint64),
                    np.array([f[1] for f in found], np.int64),
                    np.array([f[2] for f in found], np.int64),
                )
            )

    @classmethod
    def of(cls, state: dict) -> Items:
        """The items with the given ``vars``; those are plain arrays, which any executor can read."""
        items = cls.__new__(cls)
        vars(items).update(state)
        return items

    def matches(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word in the text, aligned words, equal words) of the best alignment of each item found.

        Texts are looked through together; what seems to match across their ends fails when it is compared.
        """
        ends = np.cumsum([len(t) for t in texts])
        words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
        places = set()
        for mask, seeds, items, at in self.seeds:
            own = picked(words, mask)
            if not len(seeds) or not len(own):
                continue
            near = np.zeros(FILTER, bool)
            near[seeds % np.uint64(FILTER)] = True
            hit = np.flatnonzero(near[own & np.uint64(FILTER - 1)])
            first = np.searchsorted(seeds, own[hit])
            same = seeds[np.minimum(first, len(seeds) - 1)] == own[hit]
            for place, seed in zip(hit[same].tolist(), first[same].tolist()):
                found = own[place]
                text = int(np.searchsorted(ends, place, "right"))
                begin = int(ends[text]) - len(texts[text])
                while seed < len(seeds) and seeds[seed] == found:
                    places.add((text, int(items[seed]), place - begin - int(at[seed])))
                    seed += 1
        best: dict[tuple[int, int], tuple[int, int, int, int, int]] = {}
        for text, item, start in places:
            found = self._aligned(texts[text], item, start)
            if found:
                old = best.get((text, item))
                if old is None or (found[2], -found[0]) > (old[4], -old[2]):
                    best[text, item] = (text, item, *found)
        return sorted(best.values())

    def _aligned(self, words: np.ndarray, item: int, start: int) -> tuple[int, int, int] | None:
        """The alignment that puts the item's first word at ``start``, if enough words of some window are equal."""
        own = self.words[item]
        low, high = max(0, -start), min(len(own), len(words) - start)
        if high - low < self.window <= len(own):
            return None
        equal = own[low:high] == words[start + low : start + high]
        sums = np.concatenate(([0], np.cumsum(equal)))
        # Words of a short item beyond the ends of the text are unequal.
        window = min(self.window, high - low)
        if (sums[window:] - sums[:-window]).max() < least_equal(min(self.window, len(own)), self.share):
            return None
        return start + low, high - low, int(sums[-1])


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_words`` words, cut by a hash of their id."""
    words = benchmark.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    blocks = int(words) // block_words + 1
    for block in range(blocks):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in part.collect()]
        if rows:
            yield sorted(rows)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, text_hash, item_id, start_word, n_words, n_equal, share) of every document that holds an item.

    A document holds an item if, with the item laid on it somewhere, ``window`` consecutive words of the item meet as
    many words of the document of which at least ``share`` are equal. Of an item shorter than a window, at least
    ``share`` of its words must be equal, those beyond an end of the document counting as unequal; at 0.8, items under
    five words must be there as they are. Words are letters and digits, capitals A-Z folded. Of several places, the one
    with most equal words counts.

    Each block of the benchmark is one pass over the documents without a shuffle: the block's seeds go to the tasks.
    Null and empty texts hold nothing; items that are null, without words or without id are never found. Equal rows
    give equal results once each. ``text_hash`` (xxhash64 of the text) tells rows apart whose ids repeat.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).dropna()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id long, text_hash long, item_id long, start_word long, n_words long, n_equal long"
    parts = []
    for block in _blocks(items, block_words):
        held = docs.sparkSession.sparkContext.broadcast(vars(Items(block, window, share)))
        parts.append(rows.mapInArrow(_finder(held), schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema + ", share double")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return keep_in_batches(found).withColumn("share", F.col("n_equal") / F.col("n_words"))


def _finder(held):
    names = ["doc_id", "text_hash", "item_id", "start_word", "n_words", "n_equal"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, word_hashes = Items.of(held.value), WordHashes(PLAIN)
        for batch in batches:
            doc_ids, hashes, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))
            matches = items.matches(word_hashes.all(texts))
            found = [(doc_ids[i], hashes[i], items.ids[item], start, n, equal) for i, item, start, n, equal in matches]
            columns = list(zip(*found)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return find
