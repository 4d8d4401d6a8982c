from __future__ import annotations

import datetime
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daystrata.operators.quality import stamp
from daystrata.plans.enrich import build_silver
from daystrata.sources.files import read_daily_csv, read_table
from daystrata.streaming import gold, incremental, keyed

BUCKETS = 3
DAYS = [(datetime.date(2024, 1, 1) + datetime.timedelta(d)).isoformat() for d in range(120)]


@pytest.fixture
def paths(tmp_path):
    (tmp_path / "raw").mkdir()
    return {name: str(tmp_path / name) for name in ("raw", "bronze", "silver", "gold", "ingest", "append")}


def arrive(spark, paths, after=None, max_files=None):
    incremental.ingest_new_files(spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS)
    apply = lambda session, batch: gold.apply_batch(session, paths["silver"], paths["gold"], batch)
    keyed.append_silver(spark, paths["bronze"], paths["silver"], paths["append"], max_files, BUCKETS, after=after or apply)


def same_as_batch(spark, paths):
    expected = build_silver(stamp(read_daily_csv(spark, paths["raw"]), "2024-01-01 00:00:00")).drop("ingest_ts")
    found = keyed.current_silver(spark, paths["silver"]).select(*expected.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    sums = gold._added_up(read_table(spark, f"{paths['gold']}/users").drop(keyed.BATCH), gold.USER_KEYS).filter("n_rows <> 0")
    whole = gold.full_user_sums(expected).select(*sums.columns)
    assert sums.exceptAll(whole).isEmpty() and whole.exceptAll(sums).isEmpty()


def files_of(paths):
    return {str(p): p.stat().st_mtime_ns for p in Path(paths["silver"]).rglob("*.parquet")}


def rows_of(users, days, **change):
    return [{"user_id": u, "date": d, "steps": 100 * u + 7 * int(d[-2:]), "weight_kg": 60 + u / 7, **change} for u in users for d in days]


def test_arrivals_add_up_to_the_whole(spark, tmp_path, paths, write_csv_rows):
    raw = tmp_path / "raw"
    write_csv_rows(raw / "a.csv", *rows_of(range(1, 6), DAYS[10:50]), {"user_id": None}, {"user_id": 1, "date": "never"})
    arrive(spark, paths)
    same_as_batch(spark, paths)
    before = files_of(paths)
    # Later days of some users, one of them with fewer rows than the state holds, a repeated row and a new user.
    write_csv_rows(raw / "b.csv", *rows_of((1, 2), DAYS[50:90]), *rows_of((1,), DAYS[49:50]), *rows_of((9,), DAYS[:3]))
    arrive(spark, paths)
    same_as_batch(spark, paths)
    after = files_of(paths)
    assert all(after[name] == at for name, at in before.items())
    assert not keyed._exists(spark, keyed.superseded_path(paths["silver"]))
    batches = keyed.current_silver(spark, paths["silver"]).groupBy(keyed.BATCH).agg(F.count("*").alias("n")).orderBy(keyed.BATCH)
    assert [r["n"] for r in batches.collect()] == [200, 83]
    # Earlier days of one user: all its rows are written anew, those of no other user.
    write_csv_rows(raw / "c.csv", *rows_of((2,), DAYS[:5]), *rows_of((3,), DAYS[90:95]), *rows_of((4,), DAYS[45:46], steps=1))
    arrive(spark, paths)
    same_as_batch(spark, paths)
    written = read_table(spark, paths["silver"]).filter(F.col(keyed.BATCH) == 2).groupBy("user_id").count().collect()
    assert {r["user_id"]: r["count"] for r in written} == {2: 85, 3: 5, 4: 41}
    assert all(files_of(paths)[name] == at for name, at in after.items())
    # The same file under another name, and nothing at all.
    write_csv_rows(raw / "d.csv", *rows_of((2,), DAYS[:5]), *rows_of((3,), DAYS[90:95]))
    arrive(spark, paths)
    arrive(spark, paths)
    same_as_batch(spark, paths)
    gold.compact(spark, paths["gold"])
    same_as_batch(spark, paths)
    assert read_table(spark, f"{paths['gold']}/users").count() == 6
    days = gold.dim_date(spark, paths["gold"])
    assert {r["date"].isoformat() for r in days.collect()} == {*DAYS[:5], *DAYS[10:95]}


def test_a_batch_that_fails_is_run_again(spark, tmp_path, paths, write_csv_rows):
    raw = tmp_path / "raw"
    write_csv_rows(raw / "a.csv", *rows_of((1, 2), DAYS[20:40]))
    arrive(spark, paths)
    write_csv_rows(raw / "b.csv", *rows_of((1,), DAYS[:10]), *rows_of((2,), DAYS[40:50]))

    def fail(session, batch):
        gold.apply_batch(session, paths["silver"], paths["gold"], batch)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        arrive(spark, paths, after=fail)
    arrive(spark, paths)
    same_as_batch(spark, paths)


class FakeState:
    def __init__(self):
        self.exists, self.get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_the_state_is_bounded():
    columns = ["user_id", "date", "_tie", "ingest_ts"]
    arrow = pa.schema(zip(columns, [pa.int32(), pa.date32(), pa.int64(), pa.timestamp("us")]))
    fold, state = keyed.tail_rows(arrow, 30), FakeState()
    now = pd.Timestamp("2024-01-01")
    frame = lambda days: pd.DataFrame([(1, datetime.date.fromisoformat(d), 5, now) for d in days], columns=columns)
    kinds = lambda out: [k for part in out for k in part["_kind"]]
    assert kinds(fold((1,), iter([frame(DAYS[:60]), frame(DAYS[60:80])]), state)) == ["new"] * 80
    assert keyed._unpacked(state.get[0])["date"].astype(str).tolist() == DAYS[50:80]
    assert kinds(fold((1,), iter([frame(DAYS[60:82])]), state)) == ["new"] * 2 + ["tail"] * 30
    assert kinds(fold((1,), iter([frame(DAYS[60:82])]), state)) == []
    assert kinds(fold((1,), iter([frame(DAYS[3:4] + DAYS[82:83])]), state)) == ["new"] * 2 + ["late"]
    assert keyed._unpacked(state.get[0])["date"].astype(str).tolist() == DAYS[53:83]


def test_last_rows_are_merged_in_order():
    """Rows that come behind, before and among the last ones, with copies, against sorting them all."""
    day = lambda i: datetime.date.fromisoformat(DAYS[i])
    early, late = pd.Timestamp("2024-01-01"), pd.Timestamp("2024-01-02")
    frame = lambda *rows: pd.DataFrame(rows, columns=["date", "_tie", "ingest_ts"])
    parts = [
        frame((day(5), 2, late), (day(5), 2, early), (day(4), 9, early), (day(5), -1, early)),
        frame((day(7), 1, late), (day(6), 3, early)),
        frame((day(1), 1, early), (day(6), 8, early), (day(7), 1, early)),
        frame(*[(day(10 + i), i, late) for i in range(5)]),
    ]
    for n in (1, 3, 5, 30):
        tail = None
        for i, part in enumerate(parts):
            tail = keyed._merged(tail, keyed._last(part, n), n)
            every = pd.concat(parts[: i + 1]).sort_values(["date", "_tie", "ingest_ts"]).drop_duplicates(["date", "_tie"]).tail(n)
            assert tail.values.tolist() == every.values.tolist()


def test_a_batch_gives_a_bucket_few_files(spark, tmp_path, paths, write_csv_rows):
    for part in range(4):
        write_csv_rows(tmp_path / "raw" / f"{part}.csv", *rows_of(range(1, 12), DAYS[20 * part : 20 * part + 20]))
    incremental.ingest_new_files(spark, paths["raw"], paths["bronze"], paths["ingest"], BUCKETS)
    assert read_table(spark, paths["bronze"]).count() == 880
    # One of each bucket, not one of each bucket from every task.
    assert len(list(Path(paths["bronze"]).rglob("*.parquet"))) == BUCKETS
