"""Mixing sources to target weights: whole rounds over a source, then a subset of its documents that fits the rest."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daystrata.llm.common import WORD, keep, small, text_of

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20_250
# Documents of one source and length that are ranked together.
BUCKET_ROWS = 256
# Words that the knapsack fits; of what is above, sums of long documents and then the longest documents left take most.
KNAPSACK_WORDS = 65_536
# Sums of long documents that are held against the budget.
LONG_SUMS = 20_000
BROADCAST_ROWS = 200_000


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``totals`` (source, total) with the weight and the target of each source.

    Sources in code point order, null last, take the weights in turn. All of the words are shared by weight; a source
    gets at most ``cap`` times its own, and what it cannot take is shared by weight among the others. In the order of
    cap * total / weight, that is one pass: the sources before some place are full, the rest share what is left. One
    row per source is sorted in one task, never a row per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight.cast("long")).withColumn("place", F.row_number().over(by_name))
    full = F.col("total") * cap
    order = Window.orderBy(full / F.col("weight"), "place")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared = ranked.withColumns(
        {
            "left": F.sum("total").over(everything) - before,
            "weight_left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
            "turn": F.row_number().over(order),
        }
    )
    open_ = F.col("left") * F.col("weight") < full * F.col("weight_left")
    first = shared.withColumn("first", F.min(F.when(open_, F.col("turn"))).over(everything))
    at_first = lambda name: F.max(F.when(F.col("turn") == F.col("first"), F.col(name))).over(everything)
    return first.withColumns({"left": at_first("left"), "weight_left": at_first("weight_left")}).select(
        "source",
        "total",
        "weight",
        F.when(F.coalesce(F.col("turn") >= F.col("first"), F.lit(False)), F.col("weight") * F.col("left") / F.col("weight_left"))
        .otherwise(full.cast("double"))
        .alias("target"),
    )


def fit_counts(sizes: Sequence[int], counts: Sequence[int], budget: int, knapsack_words: int = KNAPSACK_WORDS) -> list[int]:
    """How many of the ``counts`` documents of each size to take so that their words come as close to ``budget`` as can be.

    Each size first gives its proportional share, rounded down. If more than ``knapsack_words`` are left, documents of
    at least an eighth of that are chosen next, by all the sums that they can make, if these are at most LONG_SUMS; then
    long sizes give one more and so on until no more than ``knapsack_words`` are left, and a bounded knapsack over the
    documents left fits those.
    """
    total = sum(s * n for s, n in zip(sizes, counts))
    if total == 0 or budget <= 0:
        return [0] * len(sizes)
    if budget >= total:
        return list(counts)
    taken = [n * budget // total for n in counts]
    rest = budget - sum(s * t for s, t in zip(sizes, taken))
    if rest > knapsack_words:
        long = [i for i in range(len(sizes)) if 8 * sizes[i] >= knapsack_words and counts[i] > taken[i]]
        short = sum(s * (n - t) for i, (s, n, t) in enumerate(zip(sizes, counts, taken)) if i not in set(long))
        chosen = _long_ones(long, [sizes[i] for i in long], [counts[i] - taken[i] for i in long], rest, short)
        if chosen is not None:
            for i, n in chosen.items():
                taken[i] += n
                rest -= n * sizes[i]
            if rest <= 0:
                return taken
            # What is left is for the others.
            sizes = [0 if i in set(long) else s for i, s in enumerate(sizes)]
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if rest <= knapsack_words:
            break
        if sizes[i] > 0:
            more = min(counts[i] - taken[i], (rest - knapsack_words + sizes[i] - 1) // sizes[i], rest // sizes[i])
            taken[i] += more
            rest -= more * sizes[i]
    # Bit w of ``reach`` says that w words can be had; one number per size is kept to go back.
    # Sums over twice the rest are farther from it than none at all.
    usable = [i for i in sorted(range(len(sizes)), key=lambda i: sizes[i]) if 0 < sizes[i] <= 2 * rest and counts[i] > taken[i]]
    within = (1 << (2 * rest + 1)) - 1
    reach, steps = 1, []
    for i in usable:
        steps.append((i, reach))
        left, part = min(counts[i] - taken[i], 2 * rest // sizes[i]), 1
        while left > 0:
            now = min(part, left)
            reach |= (reach << (now * sizes[i])) & within
            left -= now
            part *= 2
        if reach >> rest & 1:
            break
    goal = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = reach >> (rest + 1)
    if above:
        over = rest + (above & -above).bit_length()
        goal = over if over - rest < rest - goal else goal
    for i, earlier in reversed(steps):
        while not earlier >> goal & 1:
            goal -= sizes[i]
            taken[i] += 1
    return taken


def _long_ones(names: list[int], sizes: list[int], counts: list[int], rest: int, short: int) -> dict[int, int] | None:
    """How many documents of each long size to take so that ``rest`` words are met best, given ``short`` words of others.

    Every sum that the long documents can make is kept with the way to it; None if there are more than LONG_SUMS.
    """
    ways: dict[int, tuple] = {0: ()}
    for name, size, count in zip(names, sizes, counts):
        for total, way in list(ways.items()):
            for n in range(1, min(count, (2 * rest - total) // size) + 1):
                ways.setdefault(total + n * size, (name, n, way))
            if len(ways) > LONG_SUMS:
                return None
    distance = lambda total: total - rest if total >= rest else max(0, rest - total - short)
    best = ways[min(ways, key=lambda total: (distance(total), -total))]
    chosen: dict[int, int] = {}
    while best:
        name, n, best = best
        chosen[name] = n
    return chosen


def _fitted(histogram: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each size of one source are taken once more than ``rounds`` times."""
    total, target = int(histogram["total"].iloc[0]), float(histogram["target"].iloc[0])
    budget = min(int(target + 0.5), CAP * total)
    rounds = budget // total if total else 0
    histogram = histogram.sort_values("size").copy()
    sizes, counts = [int(s) for s in histogram["size"]], [int(n) for n in histogram["n"]]
    histogram["more"] = fit_counts(sizes, counts, budget - rounds * total)
    histogram["rounds"] = rounds
    return histogram[["source", "size", "n", "more", "rounds", "total", "target"]]


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per input row: doc_id, source, size, source_size, target, copies, taken (= copies * size), and ``carry`` columns.

    A source is taken in whole rounds, then once more in part: of each size so many documents as the knapsack says,
    namely those with the smallest seeded hash of their id. Large groups of one source and size are cut into buckets by
    that hash; only within the bucket where the count is reached does the rank matter, and no bucket is large.

    Null texts have size 0, like empty ones; they are never taken and take nothing away. Null is a source of its own.
    Rows without id are dealt by a hash of their text. Equal hashes are told apart by id and text; of rows that repeat
    both it is not determined which is taken, though their number is. An empty table gives an empty result. ``carry``
    names further columns of ``docs`` to return, other than those above.
    """
    sized = keep(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(text_of(text_col)).alias("content"),
            F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried"),
        )
    )
    histogram = keep(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = source_targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total")), weights)
    totals = totals.withColumnRenamed("source", "of")
    schema = "source string, size long, n long, more long, rounds long, total long, target double"
    plan = keep(
        histogram.join(F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals, _same("source", "of"))
        .select("source", "size", "n", "total", "target")
        .groupBy("source")
        .applyInPandas(_fitted, schema)
    ).withColumnsRenamed({"source": "of", "size": "long"})
    # 32 bits of the hash, as a share of the buckets of the group.
    dealt = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), F.col("content"))).otherwise(F.xxhash64(F.lit(seed), F.col("doc_id")))
    chance = F.shiftrightunsigned(dealt, 32)
    group = sized.join(small(plan, BROADCAST_ROWS), _same("source", "of") & (F.col("size") == F.col("long"))).withColumn(
        "chance", chance
    )
    buckets = F.ceil(F.col("n") / bucket_rows)
    group = group.withColumn("bucket", F.floor(F.col("chance") * buckets / F.lit(2.0**32)).cast("long"))
    counted = group.groupBy("of", "long", "bucket").agg(F.count("*").alias("here"))
    earlier = Window.partitionBy("of", "long").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        F.col("of").alias("b_of"), F.col("long").alias("b_long"), F.col("bucket").alias("b"), F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before")
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("chance", "doc_id", "content"))
    ranked = group.withColumn("rank", rank).join(
        before, _same("source", "b_of") & (F.col("size") == F.col("b_long")) & (F.col("bucket") == F.col("b"))
    )
    copies = (F.col("rounds") + F.when(F.col("before") + F.col("rank") <= F.col("more"), 1).otherwise(0)).cast("long")
    return ranked.withColumn("copies", copies).select(
        "doc_id",
        "source",
        "size",
        F.col("total").alias("source_size"),
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *([F.col("carried")[name].alias(name) for name in carry]),
    )
