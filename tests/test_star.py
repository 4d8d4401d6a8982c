from __future__ import annotations

import datetime
import itertools
from collections import Counter, defaultdict

import pytest

from daystrata.operators import star
from daystrata.plans.enrich import build_silver


@pytest.fixture(scope="module")
def silver(make_log):
    return build_silver(
        make_log(
            {"date": "2024-09-07", "weight_kg": 82.0},
            {},
            {},
            {"user_id": 2, "gender": None, "date": "2024-09-07"},
            {"user_id": 1, "age": 31, "date": "2024-09-08"},
            {"steps": 0},
            {"date": "garbage"},
            {"user_id": None},
        )
    )


def test_dim_user_is_per_age(silver):
    users = star.build_dim_user(silver).collect()
    assert [(r.user_id, r.age, r.gender) for r in users] == [(1, 30, "M"), (1, 31, "M"), (2, 30, None)]
    assert (users[0].avg_weight_kg, users[0].avg_bmi, users[0].avg_height_cm) == (81.5, 25.0, 180.55)


def test_dim_date(silver):
    dates = star.build_dim_date(silver).collect()
    assert [(r.date_key, r.day, r.month, r.year, r.weekday) for r in dates] == [
        (20240906, 6, 9, 2024, "Friday"), (20240907, 7, 9, 2024, "Saturday"), (20240908, 8, 9, 2024, "Sunday"),
    ]
    assert dates[0].date == datetime.date(2024, 9, 6)
    assert star.build_dim_date(silver, sort=False).count() == 3


def test_dim_activity_order(silver):
    activity = star.build_dim_activity(silver)
    keys = [(r.user_id, r.date) for r in activity.collect()]
    assert keys == sorted(keys) and len(keys) == 4
    assert activity.columns == [
        "user_id", "date", "steps", "exercise_minutes", "calories_burned", "activity_level", "sleep_quality",
    ]


def test_fact_daily(silver):
    fact = star.build_fact_daily(silver)
    assert len(fact.columns) == 32 and fact.count() == 4
    second = fact.filter("user_id = 1 and date_key = 20240907").first()
    assert (second.yesterday_stress, second.yesterday_sleep, second.ra30_steps) == (5, 7.5, 8000.0)
    assert (second.weekday, second.weekday_num, second.is_weekend) == ("Saturday", 5, 1)
    assert second.stress_change_30d is None
    assert "weight_prev" not in fact.columns and "activity_level_light" not in fact.columns


def test_preview(silver):
    assert [r.user_id for r in star.preview(silver, ["user_id", "date"], 3).collect()] == [1, 1, 1]


def outer(left, right):
    """Full outer join of lists of (key, value): null keys match nothing."""
    by_key = defaultdict(lambda: ([], []))
    rows = []
    for side, values in enumerate((left, right)):
        for key, value in values:
            if key is None:
                rows.append((key, *((value, None) if side == 0 else (None, value))))
            else:
                by_key[key][side].append(value)
    for key, (a, b) in by_key.items():
        rows += [(key, x, y) for x, y in itertools.product(a or [None], b or [None])]
    return Counter(rows)


@pytest.mark.parametrize("group_rows", [None, 0, 2, 10])
def test_merge_outer(spark, group_rows):
    left = [(1, 10)] * 2 + [(1, 11), (2, 12), (None, 13), (None, 14), (None, 14), (5, 1)] + [(6, i) for i in range(20)]
    right = [(1, "a"), (1, "b"), (3, "c"), (None, "d"), (6, "e"), (6, "f"), (6, "f")] + [(7, "g")] * 5
    a, b = spark.createDataFrame(left, "k int, x int"), spark.createDataFrame(right, "k int, y string")
    merged = star.merge_outer(a, b, on=["k"], group_rows=group_rows)
    assert Counter(tuple(r) for r in merged.select("k", "x", "y").collect()) == outer(left, right)


def test_merge_of_copies_on_both_sides(spark):
    left = [(1, 5)] * 23 + [(1, 6)] * 2 + [(2, 5)] * 9
    right = [(1, "a")] * 11 + [(1, None)] * 4 + [(3, "a")] * 9
    a, b = spark.createDataFrame(left, "k int, x int"), spark.createDataFrame(right, "k int, y string")
    for group_rows in (1, 3, 7):
        merged = star.merge_outer(a, b, on=["k"], group_rows=group_rows)
        assert Counter(tuple(r) for r in merged.select("k", "x", "y").collect()) == outer(left, right)
    sizes = star._parts(a, ["k"], "_left_parts", 3).join(star._parts(b, ["k"], "_right_parts", 3), ["k"])
    cells = star._cells(a, sizes, ["k"], "_left", "_right").collect()
    held = Counter()
    for r in cells:
        held[r._left_part, r._right_part] += r._left_copies
    assert len(held) == 9 * 5 and max(held.values()) <= 4 and sum(held.values()) == 25 * 5


def test_merge_of_three_multiplies_repeated_keys(spark):
    frames = [spark.createDataFrame([(1, 1, i), (1, 1, i + 1), (2, 1, i)], f"user_id int, date_key int, c{i} int") for i in range(3)]
    for group_rows in (None, 0):
        merged = star.merge_outer(*frames, group_rows=group_rows)
        assert merged.count() == 9 and set(merged.columns) == {"user_id", "date_key", "c0", "c1", "c2"}
    with pytest.raises(ValueError, match="not unique"):
        star.merge_outer(*frames, check_unique=True)
    unique = [f.dropDuplicates(["user_id", "date_key"]) for f in frames]
    assert star.merge_outer(*unique, check_unique=True).count() == 2
