"""Silver by appending: each user's last rows are kept as keyed state, so a batch adds its own rows and no others.

Silver is a log of batches. Rows that come behind all earlier rows of their user are appended with the features that
follow from the user's last rows. A user who gets rows in between is late: all rows of that user are written again in
the batch, and the earlier ones are superseded. ``current_silver`` reads the rows that count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.operators.clean import Rules, clean_rows
from daystrata.operators.history import HALO, TIE, history, row_hash
from daystrata.plans.enrich import derived_columns, history_features
from daystrata.schema import INGEST_TS, NON_NEGATIVE, RANGE_RULES
from daystrata.sources.files import read_table, stored, write_table
from daystrata.streaming.incremental import BATCH, BUCKET, BUCKETS, user_bucket, write_counts

# Kinds of rows that the state hands on: rows of the batch, last rows before it, users whose rows come out of order.
KIND = "_kind"
NEW, TAIL, LATE = "new", "tail", "late"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

After = Callable[[SparkSession, int], None]


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except FileNotFoundError:
        return False
    return True


def superseded_path(silver_path: str) -> str:
    return f"{str(silver_path).rstrip('/')}-superseded"


def counts_path(silver_path: str) -> str:
    """Where the number of rows that each batch wrote is kept."""
    return f"{str(silver_path).rstrip('/')}-counts"


def current_silver(spark: SparkSession, silver_path: str, before: int | None = None) -> DataFrame:
    """The rows of silver that count, after all batches or those with a number below ``before``."""
    rows = read_table(spark, silver_path, "Run the refresh first.")
    if before is not None:
        rows = rows.filter(F.col(BATCH) < before)
    if not _exists(spark, superseded_path(silver_path)):
        return rows
    late = read_table(spark, superseded_path(silver_path))
    if before is not None:
        late = late.filter(F.col(BATCH) < before)
    # One row per user that was ever late; its bucket lets a filter on buckets reach both sides.
    late = late.groupBy(BUCKET, "user_id").agg(F.max(BATCH).alias("_again"))
    joined = rows.join(late, [BUCKET, "user_id"], "left")
    return joined.filter(F.col("_again").isNull() | (F.col(BATCH) >= F.col("_again"))).select(*rows.columns)


def superseded_rows(spark: SparkSession, silver_path: str, batch_id: int) -> DataFrame | None:
    """The rows that counted before a batch and do not after it; None if it made no user's rows anew."""
    path = superseded_path(silver_path)
    if not _exists(spark, silver_path) or not _exists(spark, path):
        return None
    late = read_table(spark, path).filter(F.col(BATCH) == batch_id).select(BUCKET, "user_id")
    return current_silver(spark, silver_path, before=batch_id).join(late, [BUCKET, "user_id"], "left_semi")


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    # Column by column: a user's few rows cost less than the bookkeeping of a whole frame.
    arrays = [pa.array(rows[field.name].to_numpy(), field.type, from_pandas=True) for field in schema]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_batch(pa.record_batch(arrays, schema=schema))
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_all().to_pandas(use_threads=False)


def _keys(rows: pd.DataFrame) -> list[tuple]:
    return list(zip(rows["date"].tolist(), rows[TIE].tolist()))


def _last(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    """The last ``n`` distinct rows; of copies the one stamped first."""
    day, tie = rows["date"].to_numpy().astype("datetime64[D]"), rows[TIE].to_numpy()
    order = np.lexsort((rows[INGEST_TS].to_numpy().astype("datetime64[us]"), tie, day))
    day, tie = day[order], tie[order]
    first = np.ones(len(order), bool)
    first[1:] = (day[1:] != day[:-1]) | (tie[1:] != tie[:-1])
    return rows.iloc[order[first][-n:]]


def _merged(tail: pd.DataFrame | None, last: pd.DataFrame, n: int) -> pd.DataFrame:
    """The last ``n`` of two frames of last rows; rows that come behind all of ``tail`` need no sorting again."""
    if tail is None:
        return last
    if (tail["date"].iat[-1], tail[TIE].iat[-1]) < (last["date"].iat[0], last[TIE].iat[0]):
        return last if len(last) >= n else pd.concat([tail.iloc[len(last) - n :], last], ignore_index=True)
    return _last(pd.concat([tail, last], ignore_index=True), n)


def tail_rows(arrow: pa.Schema, reach: int):
    """The state function of one user.

    Rows of the batch are handed on as they come, so a user may have any number of them; the state, and what this
    function holds, is the user's last ``reach`` distinct rows. Copies of rows in the state are passed over. If a row
    comes before the last one of the state, the user is late; else the state's rows go in front of the batch's.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        before = _unpacked(state.get[0]) if state.exists else None
        known = set(_keys(before)) if before is not None else set()
        end = max(known) if known else None
        tail, late, first = before, False, None
        for rows in batches:
            keys = _keys(rows) if known else []
            fresh = [k not in known for k in keys]
            new = rows if all(fresh) else rows[np.array(fresh)]
            if not len(new):
                continue
            first = new.head(1) if first is None else first
            late = late or (end is not None and min(k for k, is_fresh in zip(keys, fresh) if is_fresh) < end)
            tail = _merged(tail, _last(new, reach), reach)
            yield new.assign(**{KIND: NEW})
        if first is None:
            return
        state.update((_packed(tail, arrow),))
        if late:
            yield first.assign(**{KIND: LATE})
        elif before is not None:
            yield before.assign(**{KIND: TAIL})

    return fold


def _arrow_schema(spark: SparkSession, schema: T.StructType) -> pa.Schema:
    """How the state is stored. Times are those that the function sees, without a zone."""
    fields = spark.createDataFrame([], schema).toArrow().schema
    return pa.schema([pa.field(f.name, pa.timestamp("us") if pa.types.is_timestamp(f.type) else f.type) for f in fields])


def write_batch(rows: DataFrame, silver_path: str, batch_id: int, buckets: int, clamp: float | None = None) -> None:
    """Write what one batch adds to silver. Running a batch again gives the same files' contents.

    The batch has partitions of its own, so nothing that was written before is touched.
    """
    spark = rows.sparkSession
    rows = stored(rows)
    late = stored(rows.filter(F.col(KIND) == LATE).select("user_id", user_bucket(buckets).alias(BUCKET)).distinct())
    columns = [c for c in rows.columns if c not in (KIND, TIE)]
    features = history_features(clamp)
    fresh = rows.filter(F.col(KIND) != LATE).join(late.select("user_id"), "user_id", "left_anti")
    fresh = fresh.select(*columns, (F.col(KIND) == TAIL).alias(HALO))
    done = history(fresh, features, distinct=True, exclude=(INGEST_TS, HALO)).filter(~F.col(HALO)).drop(HALO)
    if not late.isEmpty():
        again = rows.filter(F.col(KIND) == NEW).join(late.select("user_id"), "user_id", "left_semi").select(*columns)
        touched = sorted(r[0] for r in late.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        if _exists(spark, silver_path):
            past = current_silver(spark, silver_path, before=batch_id).filter(F.col(BUCKET).isin(touched))
            again = again.unionByName(past.join(late.select("user_id"), "user_id", "left_semi").select(*columns))
        done = done.unionByName(history(again, features, distinct=True, exclude=(INGEST_TS,)))
        marked = late.withColumn(BATCH, F.lit(batch_id).cast("long"))
        write_table(marked, superseded_path(silver_path), (BATCH,), dynamic=True)
    shown = derived_columns(done, columns).withColumns({BUCKET: user_bucket(buckets), BATCH: F.lit(batch_id).cast("long")})
    counted = write_table(shown, silver_path, (BUCKET, BATCH), dynamic=True, counts="rows")
    write_counts(spark, counts_path(silver_path), batch_id, counted["rows"])


def append_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    max_files: int | None = None,
    buckets: int = BUCKETS,
    rules: Rules = RANGE_RULES,
    clip: tuple[str, ...] = NON_NEGATIVE,
    clamp: float | None = None,
    after: After | None = None,
) -> None:
    """Bring silver up to date with all bronze files not yet seen, in time of the new rows, and stop.

    Each user's last rows are state of the stream, on the disks of the executors and in ``checkpoint``. The rows are
    those of ``build_silver`` over all bronze; ``ingest_ts`` of copies is the earliest one within a batch, and a copy
    that comes later changes nothing. ``after`` is called with each batch's number when its rows are written.
    """
    schema = read_table(spark, bronze_path, "Run the ingest first.").schema
    # Settings of a session of its own, so that others do not see them.
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = own.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    bronze = reader.parquet(str(bronze_path)).drop(BUCKET, BATCH)
    clean = clean_rows(bronze, rules, clip)
    tied = clean.withColumn(TIE, row_hash(clean.columns, (INGEST_TS,)))
    shown = T.StructType([T.StructField(f.name, f.dataType) for f in tied.schema])
    reach = max(feature.reach for feature in history_features(clamp).values())
    fold = tail_rows(_arrow_schema(own, shown), reach)
    output = T.StructType([*shown, T.StructField(KIND, T.StringType())])
    rows = tied.groupBy("user_id").applyInPandasWithState(fold, output, "tail binary", "append", "NoTimeout")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, silver_path, batch_id, buckets, clamp)
        if after is not None:
            after(batch.sparkSession, batch_id)

    query = rows.writeStream.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
