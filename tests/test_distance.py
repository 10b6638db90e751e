"""Distance joins: equal places, missing values, counts, and how the sides meet."""

import datetime as dt
import math
import random
from collections import Counter

import pytest

from sondeframe.operators import dataset, joins


def km(a, b):
    (x, y), (u, v) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, lon double, lat double")


def test_no_side_is_collected(spark):
    """Before, the side spread over 27 cubes was broadcast, as its estimated size leaves out the spreading."""
    near, far = frame(spark, [(1, 30.0, 31.0)]), frame(spark, [(2, 30.0, 31.1)])
    for df in (joins.pairs_within(near, far), joins.count_within(near, far)):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text


@pytest.mark.parametrize(("reach", "spread"), [(25.0, 1.5), (0.05, 0.002), (3000.0, 180.0), (9000.0, 180.0), (30000.0, 180.0)])
def test_pairs_and_counts_match_brute_force_at_any_reach(spark, monkeypatch, reach, spread):
    monkeypatch.setattr(joins, "STACK", 3)
    rng = random.Random(7)
    places = [(rng.uniform(-spread, spread), max(-90.0, min(95.0, rng.uniform(-spread / 2, spread / 2)))) for _ in range(40)] + [(12.0, 90.0), (-100.0, 90.0), (180.0, 0.0), (-180.0, 0.0), (0.0, 0.0), (-0.0, 0.0)]
    sides = [[(i if i % 17 else None, *rng.choice(places)) for i in range(150)] + [(900, None, 1.0), (901, 1.0, None)] for _ in range(2)]
    near, far = (frame(spark, s) for s in sides)
    want = Counter((a[0], b[0]) for a in sides[0] for b in sides[1] if None not in (*a[1:], *b[1:]) and km(a[1:], b[1:]) < reach)
    got = joins.pairs_within(near, far, reach).collect()
    assert Counter((r.near_id, r.far_id) for r in got) == want and all(r.km < reach for r in got)
    assert joins.count_within(near, far, reach).first().n == sum(want.values())


def test_places_are_stacked_in_rows_of_a_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(joins, "STACK", 4)
    rows = joins._stacked(frame(spark, [(i, 1.0, 2.0) for i in range(10)] + [(10, 1.0, 3.0)])).collect()
    assert sorted(len(r.ids) for r in rows) == [1, 2, 4, 4] and sorted(i for r in rows for i in r.ids) == list(range(11))
    assert joins.count_within(frame(spark, []), frame(spark, [])).first().n == 0


def index(spark, rows):
    schema = "sample_id string, center_lon double, center_lat double, split string, day date, cloud_pct double, valid_pct double, region string"
    return spark.createDataFrame([(*r, dt.date(2020, 1, 1), 0.5, 1.0, "delta") for r in rows], schema)


def leaky(spark):
    rng = random.Random(9)
    places = [(30 + rng.random(), 31 + rng.random()) for _ in range(6)] + [(30.0, 95.0)]
    rows = [(f"s{i}", *places[i % 7], rng.choice(["train", "test", "val", None])) for i in range(700)]
    near, far = ([r for r in rows if r[3] == k] for k in ("test", "train"))
    return index(spark, rows), Counter((a[0], b[0]) for a in near for b in far if km(a[1:3], b[1:3]) < 25)


def test_leaks_of_shared_places_are_compared_once_a_pair_of_places(spark, monkeypatch):
    """Before, each of some 23,000 pairs of rows had its distance taken; seven places have 49 pairs."""
    df, want = leaky(spark)
    sizes, close = [], joins._close
    monkeypatch.setattr(joins, "_close", lambda a, b, km: sizes.append(close(a, b, km).count()) or close(a, b, km))
    assert Counter(map(tuple, dataset.spatial_leaks(df).select("near_id", "far_id").collect())) == want
    assert sizes[0] <= 49 < 1000 < sum(want.values())


def test_acceptance_counts_leaks_without_forming_them(spark, monkeypatch):
    df, want = leaky(spark)

    def refuse(*_):
        raise AssertionError("pairs of ids were formed")

    monkeypatch.setattr(dataset, "pairs_within", refuse)
    found = {r.check: (r.found, r.passed) for r in dataset.acceptance(df).collect()}
    assert found["spatial"] == (sum(want.values()), False) and found["temporal"] == (1, False)
    assert {r.check: r.found for r in dataset.acceptance(df.where("split = 'val'")).collect()}["spatial"] == 0
