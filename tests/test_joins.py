"""As-of and nearest joins in time buckets, against brute force."""

import datetime as dt
import random

import pytest

from sondeframe.operators import joins

START = dt.date(2019, 12, 20)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("days", [1, 3, 64, 10_000])
def test_as_of_matches_brute_force_in_buckets_of_any_size(spark, days):
    rng = random.Random(days)
    day = lambda n=200: START + dt.timedelta(rng.randrange(n))
    left = [(i, rng.choice([0, 1, 2, None]), day() if rng.random() < 0.95 else None) for i in range(250)]
    right = [(rng.choice([0, 1, None]), day(120)) for _ in range(30)] + [(1, None)]
    got = joins.as_of(spark.createDataFrame(left, "id int, k int, day date"), spark.createDataFrame(right, "k int, day date"), ["k"], "day", "match", days)
    marks = {k: sorted(d for rk, d in right if rk == k and d) for k in (0, 1, 2, None)}
    want = {i: max((d for d in marks[k] if at and d <= at), default=min(marks[k], default=None)) for i, k, at in left}
    assert {r.id: r.match for r in got.collect()} == want and got.columns == ["id", "k", "day", "match"]


@pytest.mark.parametrize("days", [1, 5, 64])
def test_nearest_date_matches_brute_force_in_buckets_of_any_size(spark, days):
    rng = random.Random(days)
    day = lambda n: START + dt.timedelta(rng.randrange(n))
    left = [(rng.randrange(3), day(300)) for _ in range(120)]
    right = [(rng.randrange(2), day(200), f"p{rng.randrange(9)}") for _ in range(40)]
    got = joins.nearest_date(spark.createDataFrame(left, "k int, day date"), spark.createDataFrame(right, "k int, day date, path string"), ["k"], "day", "path", days).collect()
    want = {(k, d): min((abs((d - rd).days), p) for rk, rd, p in right if rk == k)[1] for k, d in left if k < 2}
    assert {(r.k, r.day): r.path for r in got} == want and len(got) == len(want)


def test_timestamps_and_repeated_rows(spark):
    at = lambda h: dt.datetime(2020, 1, 1) + dt.timedelta(hours=h)
    left = spark.createDataFrame([(0, at(5)), (0, at(5)), (0, at(700)), (0, at(1))], "k int, ts timestamp")
    right = spark.createDataFrame([(0, at(3)), (0, at(3)), (0, at(6)), (0, at(60))], "k int, ts timestamp")
    got = joins.as_of(left, right, ["k"], "ts", "m", 2).collect()
    assert sorted((r.ts, r.m) for r in got) == [(at(1), at(3)), (at(5), at(3)), (at(5), at(3)), (at(700), at(60))]


def test_one_key_is_split_over_tasks(spark):
    """The window over rows is dealt by key and bucket; the one by key alone sees a row a bucket."""
    left = spark.sql("select 1 k, date_add(date'2000-01-01', cast(id as int)) day from range(5000)")
    right = left.where("dayofmonth(day) = 1")
    text = plan(joins.as_of(left, right, ["k"], "day", "m"))
    assert "_bucket" in text and all("_bucket" in x or "_e" in x for x in text.split("Window [")[1:])
    counts = joins._with_carried(right.selectExpr("k", "day _at", "day _mark"), left.selectExpr("k", "day _at"), ["k"], 64).groupBy("_bucket").count().collect()
    assert len(counts) > 70 and max(r["count"] for r in counts) <= 64 + 3


def test_sized_hints_only_small_tables(spark):
    big, small = spark.range(100), spark.range(10)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(joins.sized(small, 10)) and not hinted(joins.sized(small, 9))


def test_work_left_lists_what_is_neither_done_nor_unlabelled(spark):
    tiles = spark.createDataFrame([("a",), ("b",)], "tile string")
    years = lambda *y: spark.createDataFrame([(x,) for x in y], "year int")
    done = spark.createDataFrame([("a", 2017)], "tile string, year int")
    got = joins.work_left(tiles, years(2017, 2018, 2019), done, years(2017, 2018, 2018))
    assert sorted(map(tuple, got.collect())) == [("a", 2018), ("b", 2017), ("b", 2018)]
