from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daystrata.operators.quality import stamp
from daystrata.plans.enrich import build_silver
from daystrata.schema import DAILY_LOG_FIELDS
from daystrata.sources.files import read_daily_csv, read_table
from daystrata.streaming import incremental

BUCKETS = 4


@pytest.fixture
def paths(tmp_path):
    (tmp_path / "raw").mkdir()
    return {name: str(tmp_path / name) for name in ("raw", "bronze", "silver", "ingest", "refresh")}


def arrive(spark, paths):
    incremental.ingest_new_files(spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS)
    incremental.refresh_silver(spark, paths["bronze"], paths["silver"], paths["refresh"])


def same_as_batch(spark, paths):
    raw = stamp(read_daily_csv(spark, paths["raw"]), "2024-01-01 00:00:00")
    expected = build_silver(raw).drop("ingest_ts")
    found = read_table(spark, paths["silver"]).select(*expected.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_batches_add_up_to_the_whole(spark, tmp_path, paths, write_csv_rows):
    days = [f"2024-09-{d:02d}" for d in range(1, 29)]
    write_csv_rows(tmp_path / "raw" / "a.csv", *[{"user_id": u, "date": d, "steps": 100 * u} for u in range(6) for d in days[10:]])
    arrive(spark, paths)
    same_as_batch(spark, paths)
    untouched = read_table(spark, paths["silver"]).filter("user_id = 5").select("ingest_ts").first()[0]
    # later and earlier days, a repeated row and a new user
    write_csv_rows(
        tmp_path / "raw" / "b.csv",
        *[{"user_id": u, "date": d, "steps": 50 * u} for u in (1, 9) for d in days[:5]],
        {"user_id": 1, "date": days[10], "steps": 100},
    )
    arrive(spark, paths)
    same_as_batch(spark, paths)
    assert read_table(spark, paths["silver"]).filter("user_id = 5").select("ingest_ts").distinct().collect()[0][0] == untouched
    assert read_table(spark, paths["bronze"]).count() == 6 * 18 + 11
    # nothing new
    arrive(spark, paths)
    same_as_batch(spark, paths)
    assert read_table(spark, paths["bronze"]).count() == 6 * 18 + 11


def test_files_one_by_one(spark, tmp_path, paths, write_csv_rows):
    for i in range(3):
        write_csv_rows(tmp_path / "raw" / f"{i}.csv", {"user_id": i}, {"user_id": 0, "date": f"2024-10-0{i + 1}"})
    incremental.ingest_new_files(spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS, max_files=1)
    incremental.refresh_silver(spark, paths["bronze"], paths["silver"], paths["refresh"], max_files=1)
    same_as_batch(spark, paths)


def test_a_batch_may_run_twice(spark, paths, tmp_path, write_csv_rows):
    write_csv_rows(tmp_path / "raw" / "a.csv", {"user_id": 1}, {"user_id": 2})
    arrive(spark, paths)
    batch = read_table(spark, paths["bronze"]).select(incremental.BUCKET)
    incremental.refresh_buckets(batch, paths["bronze"], paths["silver"])
    incremental.refresh_buckets(batch.limit(0), paths["bronze"], paths["silver"])
    same_as_batch(spark, paths)


def test_refresh_reads_only_touched_buckets(spark, paths, tmp_path, write_csv_rows):
    write_csv_rows(tmp_path / "raw" / "a.csv", *[{"user_id": u} for u in range(20)])
    incremental.ingest_new_files(spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS)
    bronze = read_table(spark, paths["bronze"])
    bucket = bronze.select(incremental.BUCKET).first()[0]
    plan = build_silver(bronze.filter(F.col(incremental.BUCKET).isin([bucket])))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [(user_bucket#" in plan.replace("isnotnull(", "(") or "PartitionFilters: [isnotnull(user_bucket" in plan


def test_wrong_header_stops_the_stream(spark, paths, tmp_path, write_csv_rows):
    write_csv_rows(tmp_path / "raw" / "a.csv", {}, header=list(reversed(DAILY_LOG_FIELDS)))
    with pytest.raises(Exception, match="STREAM_FAILED.*FAILED_READ_FILE"):
        incremental.ingest_new_files(spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS)


def test_files_are_bound_by_their_own_headers(spark, paths, tmp_path, write_csv_rows):
    raw, turned = tmp_path / "raw", list(reversed(DAILY_LOG_FIELDS))
    write_csv_rows(raw / "a.csv", {"user_id": 1}, {"user_id": 2})
    write_csv_rows(raw / "b.csv", {"user_id": 3}, {"user_id": 4, "steps": 5}, header=turned)
    counts = str(tmp_path / "counts")
    ingest = lambda **more: incremental.ingest_by_header(
        spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS, counts_path=counts, **more
    )
    ingest(max_files=1)
    write_csv_rows(raw / "c.csv", {"user_id": 5, "gender": '"a\nb"'}, header=turned)
    ingest()
    ingest()
    found = read_table(spark, paths["bronze"])
    assert sorted((r["user_id"], r["steps"], r["gender"]) for r in found.collect())[2:] == [(3, 8000, "M"), (4, 5, "M"), (5, 8000, "a\nb")]
    assert {r["batch"]: r["rows"] for r in read_table(spark, counts).collect()} == {0: 2, 1: 2, 2: 1}
    assert {r["batch"]: r["count"] for r in found.groupBy("batch").count().collect()} == {0: 2, 1: 2, 2: 1}
    # A batch with a header that does not fit leaves nothing behind.
    write_csv_rows(raw / "d.csv", {"user_id": 6})
    write_csv_rows(raw / "e.csv", {"user_id": 7}, header=turned[1:])
    with pytest.raises(Exception, match="absent"):
        ingest()
    assert read_table(spark, paths["bronze"]).count() == 5


def test_refresh_needs_bronze(spark, paths):
    with pytest.raises(FileNotFoundError, match="Run the ingest first"):
        incremental.refresh_silver(spark, paths["bronze"], paths["silver"], paths["refresh"])
