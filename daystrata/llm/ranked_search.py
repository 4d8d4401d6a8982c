"""Ranked lexical search: bundles of items pass the owners of terms in turn, and each adds its part of the scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.common import keep, small, text_of
from daystrata.llm.words import PLAIN

TOP = 20
# Documents, and bytes of their texts, that are indexed and scored together.
PACK_DOCUMENTS = 4_096
PACK_BYTES = 16 << 20
# Stages that a bundle passes; items in a bundle.
OWNERS = 4
BUNDLE_ITEMS = 64
# Terms of items that are searched in one pass (about); more items take more passes.
BLOCK_TERMS = 500_000
BROADCAST_ROWS = 200_000
# Java pattern of a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# No part of a score per weight reaches this (10^9 * tf div (1000 * tf + 12 * m) with m > 0).
MOST = 1_000_000
POSTINGS = "pack long, ids {ids}, lengths binary, terms binary, docs binary, counts binary"
OWNED = "pack long, owner int, terms binary, docs binary, parts binary, ids {ids}"
BUNDLES = "pack long, bundle int, size int, sizes binary, docs binary, scores binary"


def terms_of(text: str | None) -> list[bytes]:
    """Letters and digits of ASCII and all other characters make terms; A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


class Queries:
    """Items of a pass: their distinct terms, numbered, and how often an item has each."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.term: dict[bytes, int] = {}
        self.numbers, self.terms = [], []
        for number, text in items:
            counts = Counter(terms_of(text))
            if counts:
                self.numbers.append(number)
                self.terms.append([(self.term.setdefault(t, len(self.term)), n) for t, n in counts.items()])


@dataclass
class Owners:
    """Weights of terms, the stage that owns each, and the sums that the scores depend on."""

    weights: np.ndarray
    owner: np.ndarray
    documents: int
    length: int

    @classmethod
    def of(cls, frequency: np.ndarray, documents: int, length: int, owners: int) -> Owners:
        """Terms are dealt out by weight, the highest first, so that each owner has about as many postings."""
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)
        order = np.lexsort((np.arange(len(weights)), -weights))
        middle = 2 * np.cumsum(frequency[order]) - frequency[order]
        owner = np.empty(len(weights), np.int64)
        owner[order] = np.minimum(middle * owners // max(1, 2 * int(frequency.sum())), owners - 1)
        return cls(weights, owner, documents, length)

    def parts(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a term with weight 1 adds to documents that have it ``counts`` times among ``lengths`` terms."""
        m = 100 - 25 + (25 * lengths * self.documents) // self.length
        return (1_000_000_000 * counts) // (1_000 * counts + 12 * m)


def postings(docs: DataFrame, queries: Queries) -> DataFrame:
    """One row per pack of documents: their ids in order, their lengths, and postings of the queries' terms by term."""
    ids = docs.schema["doc_id"].dataType
    schema = T.StructType.fromDDL(POSTINGS.format(ids=f"array<{ids.simpleString()}>"))
    term = queries.term

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").to_pylist()
            first = 0
            while first < len(texts):
                size, end = 0, first
                while end < len(texts) and (end == first or size + len(texts[end]) <= PACK_BYTES) and end - first < PACK_DOCUMENTS:
                    size += len(texts[end])
                    end += 1
                yield row(batch.column("doc_id").slice(first, end - first), texts[first:end], pack)
                first, pack = end, pack + 1

    def row(own: pa.Array, texts: list[str], pack: int) -> pa.RecordBatch:
        # In the order of ids, so that places tell ties apart.
        order = pc.array_sort_indices(own, order="ascending").to_pylist()
        lengths, owners, found = np.zeros(len(texts), np.int64), [], []
        for place, at in enumerate(order):
            words = terms_of(texts[at])
            lengths[place] = len(words)
            met = [term[w] for w in words if w in term]
            found.append(met)
            owners.append(len(met))
        flat = np.fromiter((t for met in found for t in met), np.int64, sum(owners))
        code, counts = np.unique(flat << 32 | np.repeat(np.arange(len(texts)), owners), return_counts=True)
        binary = [(code >> 32).astype(np.int32), (code & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int32)]
        values = [[pack], pa.array([own.take(pa.array(order, pa.int64())).to_pylist()], pa.list_(own.type)), [lengths.tobytes()]]
        values += [[b.tobytes()] for b in binary]
        kinds = [pa.int64(), None, *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([v if k is None else pa.array(v, k) for v, k in zip(values, kinds)], schema.names)

    return docs.mapInArrow(index, schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): documents that have a term; as terms -1 and -2, documents with terms and the terms of all."""
    for batch in batches:
        for lengths, terms in zip(batch.column("lengths").to_pylist(), batch.column("terms").to_pylist()):
            n = np.frombuffer(lengths, np.int64)
            term, count = np.unique(np.frombuffer(terms, np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*term.tolist(), -1, -2], pa.int64()), pa.array([*count.tolist(), int((n > 0).sum()), int(n.sum())], pa.int64())],
                ["term", "n"],
            )


def _owned(packs: DataFrame, owners: Owners, stages: int) -> DataFrame:
    """Each pack's postings dealt to the owners of their terms, with what they add per weight; the last has the ids."""
    schema = T.StructType.fromDDL(OWNED.format(ids=packs.schema["ids"].dataType.simpleString()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("lengths", "terms", "docs", "counts")
            for at, (pack, *raw) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("pack", *names)))):
                lengths = np.frombuffer(raw[0], np.int64)
                terms, docs, counts = (np.frombuffer(r, np.int32) for r in raw[1:])
                parts = owners.parts(counts.astype(np.int64), lengths[docs]).astype(np.int32) if len(terms) else counts
                owner = owners.owner[terms]
                columns = []
                for stage in range(stages):
                    own = owner == stage
                    columns.append((pack, stage, terms[own].tobytes(), docs[own].tobytes(), parts[own].tobytes()))
                ids = pa.concat_arrays([pa.nulls(stages - 1, batch.column("ids").type), batch.column("ids").slice(at, 1)])
                kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 3)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*columns), kinds)), ids], schema.names)

    return packs.mapInArrow(deal, schema)


def _empty_bundles(packs: DataFrame, n_items: int, bundle_items: int) -> DataFrame:
    """A bundle of items without scores for every pack and ``bundle_items`` items."""
    bundles = F.explode(F.sequence(F.lit(0), F.lit((n_items - 1) // bundle_items))).alias("bundle")
    nothing = F.lit(b"").alias
    size = F.size("ids").alias("size")
    return packs.select("pack", bundles, size, F.lit(b"\0" * 8 * bundle_items).alias("sizes"), nothing("docs"), nothing("scores"))


class Stage:
    """What one owner does to the bundles of a pack."""

    def __init__(self, queries: Queries, owners: Owners, stage: int, bundle_items: int, top: int):
        self.bundle_items, self.top = bundle_items, top
        self.items = [[(t, n * int(owners.weights[t])) for t, n in terms if owners.owner[t] == stage] for terms in queries.terms]
        # What later owners can add at most.
        self.later = [sum(n * int(owners.weights[t]) for t, n in terms if owners.owner[t] > stage) * MOST for terms in queries.terms]

    def scored(self, mine: pd.DataFrame, theirs: pd.DataFrame) -> Iterator[tuple]:
        """(row of a bundle, [(item, docs, scores)]): accumulators after this stage, of documents that can still be among the best.

        A document is left out of an item's accumulators if so many others of the pack are ahead of it that, with all
        that later owners can add, it stays behind them. What later stages add to it again is less than its score.
        """
        terms, docs, parts = (np.frombuffer(theirs[name].iloc[0], np.int32) for name in ("terms", "docs", "parts"))
        parts = parts.astype(np.int64)
        for row in mine.itertuples(index=False):
            first = row.bundle * self.bundle_items
            items = self.items[first : first + self.bundle_items]
            sizes = np.frombuffer(row.sizes, np.int64)
            ends = np.cumsum(sizes)
            had, scores = np.frombuffer(row.docs, np.int32), np.frombuffer(row.scores, np.int64)
            found = []
            for i, item in enumerate(items):
                total = np.zeros(row.size, np.int64)
                before = slice(ends[i] - sizes[i], ends[i])
                total[had[before]] = scores[before]
                for term, weight in item:
                    begin, end = np.searchsorted(terms, (term, term + 1))
                    total[docs[begin:end]] += weight * parts[begin:end]
                found.append((first + i, *self.leading(total, self.later[first + i])))
            yield row, found

    def leading(self, total: np.ndarray, later: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(total)
        if len(at) > self.top:
            least = np.partition(total[at], len(at) - self.top)[len(at) - self.top]
            at = at[total[at] + later >= least]
        return at, total[at]

    def add(self, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row, found in self.scored(mine, theirs):
            sizes = np.zeros(self.bundle_items, np.int64)
            sizes[: len(found)] = [len(f[1]) for f in found]
            docs, scores = (np.concatenate([f[k] for f in found]) for k in (1, 2))
            rows.append((row.pack, row.bundle, row.size, sizes.tobytes(), docs.astype(np.int32).tobytes(), scores.tobytes()))
        return pd.DataFrame(rows, columns=["pack", "bundle", "size", "sizes", "docs", "scores"])

    def select(self, mine: pa.Table, theirs: pa.Table, numbers: list[int]) -> pa.Table:
        """The best documents of the pack for every item; of equal scores those with the least ids."""
        ids = theirs.column("ids").combine_chunks().flatten()
        columns: list[list[np.ndarray]] = [[], [], []]
        for _, found in self.scored(mine.to_pandas(), theirs.drop_columns(["ids"]).to_pandas()):
            for item, docs, scores in found:
                best = np.lexsort((docs, -scores))[: self.top]
                for column, values in zip(columns, (np.full(len(best), numbers[item]), docs[best], scores[best])):
                    column.append(values)
        number, docs, scores = (np.concatenate([np.zeros(0, np.int64), *c]) for c in columns)
        return pa.table({"number": pa.array(number, pa.int64()), "doc_id": ids.take(pa.array(docs, pa.int64())), "score": pa.array(scores, pa.int64())})


def _visit(stage: Stage):
    return lambda mine, theirs: stage.add(mine, theirs)


def search_block(docs: DataFrame, queries: Queries, top: int, owners: int, bundle_items: int) -> DataFrame:
    """(number, doc_id, score): for every item, the best of each pack of documents."""
    packs = keep(postings(docs, queries))
    counted = dict(packs.select("lengths", "terms").mapInArrow(_sums, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    frequency = np.array([counted.get(t, 0) for t in range(len(queries.term))], np.int64)
    dealt = Owners.of(frequency, counted.get(-1, 0), max(1, counted.get(-2, 0)), owners)
    owned = keep(_owned(packs, dealt, owners))
    bundles = _empty_bundles(packs, len(queries.numbers), bundle_items)
    for number in range(owners):
        stage = Stage(queries, dealt, number, bundle_items, top)
        visited = bundles.groupBy("pack").cogroup(owned.filter(F.col("owner") == number).groupBy("pack"))
        if number < owners - 1:
            bundles = visited.applyInPandas(_visit(stage), BUNDLES)
    numbers = queries.numbers
    result = T.StructType([T.StructField("number", T.LongType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
    return visited.applyInArrow(lambda mine, theirs: stage.select(mine, theirs, numbers), result)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    owners: int = OWNERS,
    bundle_items: int = BUNDLE_ITEMS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item its ``top`` documents with the highest scores above 0: item_id, rank (from 1), doc_id, score.

    Terms are dealt to ``owners`` by weight. Bundles of items, one for every pack of documents, visit the owners one
    after the other; each adds what its terms bring, in whole numbers, to the bundle's sparse sums of documents. The
    last one selects the best of a pack, a window the best of all. Sums that can no longer be among the best of their
    pack are not carried on; ranks and scores are exact. Packs follow the layout of the input, so no term, however many
    documents have it, makes a large group.

    Null and empty texts and items have no terms: such documents are found by nothing, such items find nothing. Equal
    scores are ranked by id, rows without id last; rows that repeat an id are documents of their own, and so are rows
    that repeat an item. Without documents or items the result is empty. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    asked = items.select(F.col(item_id_col).alias("item_id"), text_of(item_text_col).alias("text"))
    asked = keep(asked.withColumn("number", F.monotonically_increasing_id()))
    blocks = -(-(asked.agg(F.sum(F.regexp_count("text", F.lit(TERM)))).first()[0] or 0) // block_terms)
    of_block = F.pmod(F.xxhash64("number"), F.lit(max(1, blocks)))
    found = []
    for block in range(blocks):
        queries = Queries([(r["number"], r["text"]) for r in asked.filter(of_block == block).select("number", "text").collect()])
        if queries.numbers:
            found.append(search_block(rows, queries, top, owners, bundle_items))
    if not found:
        fields = [asked.schema["item_id"], T.StructField("rank", T.IntegerType(), False), rows.schema["doc_id"], T.StructField("score", T.LongType())]
        return docs.sparkSession.createDataFrame([], T.StructType(fields))
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(small(asked.drop("text"), BROADCAST_ROWS), "number").select("item_id", "rank", "doc_id", "score")
