"""Finding groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group beyond this many rows may be worth splitting.
GROUP_ROWS = 1_000_000

# A group is split if it also holds more than 1/MAX_SPLIT of all rows, so there can be no more of them than this and
# the list of their keys can safely be broadcast.
MAX_SPLIT = 20_000

# Buckets in which keys are counted first.
COUNT_BUCKETS = 65_536

# Below this many estimated bytes the whole input fits one task, so no group in it needs splitting.
ONE_TASK_BYTES = 256 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the frame, or None where the session does not expose it."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except (AttributeError, TypeError):
        return None


def large_groups(df: DataFrame, keys: Sequence[str], group_rows: int | None = None) -> DataFrame | None:
    """Keys of the groups above ``group_rows`` rows (at most MAX_SPLIT of them), or None if there are none.

    By default a group is large above GROUP_ROWS rows and 1/MAX_SPLIT of all rows, and inputs that fit one task are
    not looked at. Rows are counted per bucket of keys, of which a task passes on a fixed number however many keys
    it sees; only if a bucket is large are its keys counted one by one. The scans read the key columns only.
    """
    if group_rows is None:
        size = estimated_bytes(df)
        if size is not None and size < ONE_TASK_BYTES:
            return None
    bucketed = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(COUNT_BUCKETS)).alias("_bucket"))
    buckets = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    rows, largest = buckets.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(GROUP_ROWS, (rows or 0) // MAX_SPLIT) if group_rows is None else group_rows
    if largest is None or largest <= limit:
        return None
    # At most COUNT_BUCKETS rows, and with the default limit at most MAX_SPLIT.
    full = F.broadcast(buckets.filter(F.col("_rows") > limit).select("_bucket"))
    counts = bucketed.join(full, "_bucket", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.filter(F.col("_rows") > limit).orderBy(F.desc("_rows")).limit(MAX_SPLIT)
    found = large.select(*keys).collect()
    if not found:
        return None
    return df.sparkSession.createDataFrame([tuple(row) for row in found], df.select(*keys).schema)


def join_same(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null matches null; the key columns of ``right`` are not repeated."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{c}" for c in cols])


def split_by_keys(df: DataFrame, keys: Sequence[str], large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of all other groups, rows of the groups in ``large``); ``large`` has at most MAX_SPLIT rows."""
    small_side = F.broadcast(large)
    return join_same(df, small_side, keys, "left_anti"), join_same(df, small_side, keys, "left_semi")
