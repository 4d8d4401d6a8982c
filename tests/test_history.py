from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from daystrata.operators import history as h
from daystrata.operators import skew
from daystrata.operators.clean import dedup_rows

FIRST = datetime.date(2024, 1, 1)


def day(n):
    return FIRST + datetime.timedelta(days=n)


def sample(seed=7, users=(1, 2, 3, None), size=90, gap=3):
    """Rows (user, date, value) with one row per user and day, gaps and null values."""
    rng = random.Random(seed)
    rows = []
    for user in users:
        at = 0
        for _ in range(rng.randrange(1, size)):
            at += rng.randrange(1, gap + 1)
            rows.append((user, day(at), None if rng.random() < 0.1 else float(rng.randrange(100))))
    rng.shuffle(rows)
    return rows


SPEC = {
    "prev": h.Previous("v"),
    "back3": h.Previous("v", 3),
    "change": h.Change("v", 5),
    "held": h.Change("v", 5, clamp=10),
    "mean": h.TrailingMean("v", 7),
}


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def change(a, b, clamp=None):
    if a is None or b is None:
        return None
    return a - b if clamp is None else max(-clamp, min(clamp, a - b))


def by_rows(rows):
    groups = defaultdict(list)
    for user, date, v in rows:
        groups[user].append((date, v))
    expected = {}
    for user, series in groups.items():
        series.sort()
        values = [v for _, v in series]
        for i, (date, v) in enumerate(series):
            back = lambda n: values[i - n] if i >= n else None
            expected[user, date] = (
                back(1), back(3), change(v, back(5)), change(v, back(5), 10), mean(values[max(0, i - 6) : i + 1]),
            )
    return expected


def by_days(rows):
    values = {(user, date): v for user, date, v in rows}
    expected = {}
    for (user, date), v in values.items():
        back = lambda n: values.get((user, date - datetime.timedelta(days=n)))
        expected[user, date] = (
            back(1), back(3), change(v, back(5)), change(v, back(5), 10), mean([back(n) for n in range(7)]),
        )
    return expected


def result(df):
    return {(r.user_id, r.date): tuple(r[name] for name in SPEC) for r in df.collect()}


def close(found, expected):
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values), key


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "user_id int, date date, v double")


@pytest.mark.parametrize("group_rows", [None, 1, 4, 30, 10_000])
@pytest.mark.parametrize("rows_or_days", ["rows", "days"])
def test_history_against_brute_force(frame, group_rows, rows_or_days):
    rows = sample()
    expected = by_rows(rows) if rows_or_days == "rows" else by_days(rows)
    close(result(h.history(frame(rows), SPEC, frame=rows_or_days, group_rows=group_rows)), expected)


@pytest.mark.parametrize("seed", range(2))
def test_chunks_of_any_size(frame, seed):
    rows = sample(seed, users=(1, 2), size=200, gap=1)
    for group_rows in (1, 3, 8):
        close(result(h.history(frame(rows), SPEC, group_rows=group_rows)), by_rows(rows))


@pytest.mark.parametrize("group_rows", [None, 3, 20])
def test_distinct_in_the_same_pass(frame, group_rows):
    rows = sample(11)
    doubled = rows + rows[::2] + rows[:5] * 20
    close(result(h.history(frame(doubled), SPEC, distinct=True, group_rows=group_rows)), by_rows(rows))


def test_distinct_treats_equal_floats_alike(frame):
    nan = float("nan")
    rows = [(1, day(0), 0.0), (1, day(0), -0.0), (1, day(1), nan), (1, day(1), nan), (1, day(2), None), (1, day(2), None)]
    for group_rows in (None, 1):
        assert h.history(frame(rows), {"p": h.Previous("v")}, distinct=True, group_rows=group_rows).count() == 3
    assert dedup_rows(frame(rows)).count() == 3


def test_distinct_keeps_the_earliest_stamp(spark):
    rows = [(1, day(0), 1.0, 9), (1, day(0), 1.0, 4), (1, day(1), 2.0, 7)]
    df = spark.createDataFrame(rows, "user_id int, date date, v double, stamp int")
    for group_rows in (None, 1):
        found = h.history(df, {"p": h.Previous("v")}, distinct=True, exclude=["stamp"], group_rows=group_rows)
        assert sorted((r.stamp, r.p) for r in found.collect()) == [(4, None), (7, 1.0)]


@pytest.mark.parametrize("frame_of", ["rows", "days"])
@pytest.mark.parametrize("distinct", [False, True])
def test_both_paths_agree_bit_for_bit(spark, frame_of, distinct):
    """Fractions, nulls, ties, copies and null stamps."""
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 2, None]), day(rng.randrange(40)), rng.choice([None, rng.random()]), rng.choice([None, 1.0]), rng.choice([None, 4, 9]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows + rows[:60], "user_id int, date date, v double, w double, stamp int")
    options = {"frame": frame_of, "distinct": distinct, "exclude": ["stamp"]}
    shown = lambda found: found if distinct else found.drop("stamp")
    plain = shown(h.history(df, SPEC, **options)).collect()
    split = shown(h.history(df, SPEC, group_rows=10, **options)).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, split))


def test_stamps_of_copies_are_null_last(spark):
    df = spark.createDataFrame([(1, day(0), 1.0, None), (1, day(0), 1.0, 4)], "user_id int, date date, v double, stamp int")
    for group_rows in (None, 0):
        assert h.history(df, {"p": h.Previous("v")}, distinct=True, exclude=["stamp"], group_rows=group_rows).first().stamp == 4
    two = df.withColumn("other", F.lit(None).cast("int"))
    assert dedup_rows(two, ["stamp", "other"]).first().stamp == 4


@pytest.mark.parametrize("days", [1, 3])
def test_many_rows_on_one_day_of_one_user(frame, days):
    """A key whose rows nearly all fall on one day is still cut up, and every split sees the same order."""
    rng = random.Random(3)
    rows = [(1, day(rng.randrange(days)), float(i)) for i in range(3000)] + [(2, day(0), 1.0)]
    df = frame(rows)
    spec = {"prev": h.Previous("v"), "mean": h.TrailingMean("v", 7), "change": h.Change("v", 5)}
    plain = h.history(df, spec)
    split = h.history(df, spec, group_rows=100)
    assert plain.count() == len(rows)
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    chunks = h._chunks(
        df.filter("user_id = 1").withColumn(h.TIE, h.row_hash(df.columns, [])).withColumn(
            h.SLICE, F.shiftright(h.TIE, 64 - h.SLICE_BITS).cast("int")
        ),
        ["user_id"], ["date"], 100,
    )
    sizes = [r[0] for r in chunks.groupBy(h.CHUNK).agg(F.sum("_n")).collect()]
    assert len(sizes) >= 25 and max(sizes) <= 200


def test_rows_before_a_chunk_are_all_there(frame):
    """Chunks shorter than the reach draw on several earlier chunks."""
    rows = [(1, day(i), float(i)) for i in range(40)]
    spec = {"mean": h.TrailingMean("v", 30), "back": h.Previous("v", 30)}
    found = {r.date: (r.mean, r.back) for r in h.history(frame(rows), spec, group_rows=2).collect()}
    for i in range(40):
        window = list(range(max(0, i - 29), i + 1))
        assert found[day(i)] == (sum(window) / len(window), float(i - 30) if i >= 30 else None)


def test_null_dates_form_their_own_place(frame):
    rows = [(1, None, 5.0), (1, day(0), 6.0), (None, None, 7.0)]
    for group_rows in (None, 0):
        found = h.lag_features(frame(rows), {"p": ("v", 1)}, group_rows=group_rows).collect()
        assert sorted((r.v, r.p) for r in found) == [(5.0, None), (6.0, 5.0), (7.0, None)]


def test_wrappers(frame):
    rows = [(1, day(i), float(i * i)) for i in range(10)]
    df = frame(rows)
    last = lambda out: max(out.collect(), key=lambda r: r.date)
    assert last(h.lag_features(df, {"p": ("v", 2)})).p == 49.0
    assert last(h.change_over(df, {"c": "v"}, 7)).c == 81.0 - 4.0
    assert last(h.change_over(df, {"c": "v"}, 7, clamp=5)).c == 5.0
    assert last(h.rolling_mean(df, {"m": "v"}, 2)).m == (64 + 81) / 2
    assert last(h.rolling_mean(df, {"m": "v"}, 2, frame="days")).m == (64 + 81) / 2
    with pytest.raises(ValueError):
        h.rolling_mean(df, {"m": "v"}, frame="weeks")
    assert h.duplicate_keys(df.union(df.limit(1)), ["user_id", "date"]).count() == 1


def test_large_groups(frame, monkeypatch):
    df = frame([(1, day(i), 0.0) for i in range(5)] + [(2, day(i), 0.0) for i in range(3)] + [(3, day(0), 0.0)])
    found = lambda *args: [r[0] for r in skew.large_groups(df, ["user_id"], *args).collect()]
    assert skew.large_groups(df, ["user_id"]) is None
    assert skew.large_groups(df, ["user_id"], 5) is None
    assert skew.large_groups(df.limit(0), ["user_id"], 0) is None
    assert found(3) == [1] and sorted(found(0)) == [1, 2, 3]
    monkeypatch.setattr(skew, "COUNT_BUCKETS", 1)
    assert found(3) == [1]
    assert skew.large_groups(df, ["user_id"], 5) is None
    monkeypatch.setattr(skew, "MAX_SPLIT", 1)
    assert found(2) == [1]
    monkeypatch.setattr(skew, "ONE_TASK_BYTES", 0)
    assert skew.large_groups(df, ["user_id"]) is None
    monkeypatch.setattr(skew, "GROUP_ROWS", 4)
    assert skew.large_groups(df, ["user_id"]) is None  # no user holds more than all rows
    monkeypatch.setattr(skew, "MAX_SPLIT", 2)
    assert found() == [1]
    rest, big = skew.split_by_keys(df, ["user_id"], skew.large_groups(df, ["user_id"]))
    assert (rest.count(), big.count()) == (4, 5)


def test_counting_reads_the_keys_only(spark, frame, tmp_path):
    frame([(1, day(i), 0.0) for i in range(5)]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    keys = df.select("user_id").groupBy(F.pmod(F.xxhash64("user_id"), F.lit(4))).count()
    assert "ReadSchema: struct<user_id:int>" in keys._jdf.queryExecution().executedPlan().toString()
    found = h.history(df.filter("v >= 0"), SPEC, group_rows=2, sized_by=df)
    close(result(found), by_rows([tuple(r) for r in df.collect()]))
