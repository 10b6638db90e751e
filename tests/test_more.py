"""Arguments, errors, wide-latitude distances, nearest dates and pushed-down scans."""

import datetime as dt
import math
import random

import pytest

from sondeframe.functions import dates
from sondeframe.operators import dataset, joins
from sondeframe.sources import readers


def test_argument_checks():
    assert dates.parse_year_month("2023-08") == (2023, 8) and dates.year_range(2001) == ("2001-01-01", "2001-12-31")
    for bad in ("2023", "2023-13", "1980-01", "a-b"):
        with pytest.raises(ValueError):
            dates.parse_year_month(bad)
    with pytest.raises(ValueError):
        dates.year_range(1999)
    assert dates.resolve_source("a", {"a": "x"}) == "x" and dates.resolve_source("b", {}, "y") == "y"
    with pytest.raises(ValueError):
        dates.resolve_source("b", {"a": "x"})
    assert readers.parse_years("2017-2019,2024") == [2017, 2018, 2019, 2024] and readers.parse_box("1,2,3,4") == (1, 2, 3, 4)
    for bad in ("3,2,1,4", "1,4,3,2", "1,2,300,4"):
        with pytest.raises(ValueError):
            readers.parse_box(bad)


def km(a, b):
    (x, y), (u, v) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


def test_distance_join_at_the_poles_and_across_the_date_line(spark):
    rng = random.Random(2)
    points = [(i, rng.uniform(-180, 180), rng.choice([rng.uniform(84, 90), rng.uniform(-90, -84)])) for i in range(400)]
    points += [(1000 + i, rng.choice([179.9, -179.9, 180.0, -180.0]) + rng.uniform(-0.05, 0.05), rng.uniform(-1, 1)) for i in range(100)] + [(2000, 10.0, 75.0), (2001, 10.84, 75.0)]
    df = spark.createDataFrame(points, "id long, lon double, lat double")
    got = {(r.near_id, r.far_id) for r in joins.pairs_within(df, df, 25.0).collect()}
    assert got == {(a[0], b[0]) for a in points for b in points if km(a[1:], b[1:]) < 25}


def test_nearest_date_matches_brute_force(spark):
    rng = random.Random(4)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(60))
    left = [(rng.randrange(3), day()) for _ in range(60)]
    right = [(rng.randrange(2), day(), f"p{rng.randrange(5)}") for _ in range(25)]
    got = joins.nearest_date(spark.createDataFrame(left, "k int, day date"), spark.createDataFrame(right, "k int, day date, path string"), ["k"], "day", "path").collect()
    want = {(k, d): min((abs((d - rd).days), p) for rk, rd, p in right if rk == k)[1] for k, d in left if k < 2}
    assert {(r.k, r.day): r.path for r in got} == want and len(got) == len(want)


def test_strict_checks_raise(spark):
    a, b = (spark.createDataFrame([(m,) for m in ms], "ym int") for ms in ([202001, 202002], [202001]))
    joins.require_same_months(a, a)
    with pytest.raises(ValueError, match="202002"):
        joins.require_same_months(a, b)
    row = ("s1", dt.date(2020, 1, 1), 25.0, 33.0, 0.1, 1.0, "em_shelf", "train")
    schema = "sample_id string, day date, center_lon double, center_lat double, cloud_pct double, valid_pct double, region string, split string"
    dataset.require_accepted(spark.createDataFrame([row], schema))
    with pytest.raises(ValueError, match="spatial: 1.*temporal: 1"):
        dataset.require_accepted(spark.createDataFrame([row, ("s2", *row[1:7], "test")], schema))
    assert dataset.inside(spark.createDataFrame([row, ("s3", *row[1:7], "none")], schema)).count() == 1


def test_scans_are_pruned_and_pushed_down(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(100).selectExpr("cast(id as double) longitude", "cast(id as double) latitude", "date'2020-01-01' time", "2020 + cast(id % 3 as int) year", "1 + cast(id % 12 as int) month").write.partitionBy("year", "month").parquet(path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    months = readers.read_months(spark, path, [(2020, 1)])
    assert "PartitionFilters: [" in plan(months) and "year" in plan(months).split("PartitionFilters")[1][:120] and len(months.inputFiles()) > 0
    assert "GreaterThanOrEqual(longitude,10.0)" in plan(readers.read_box(spark, path, (10, 10, 20, 20)))
    with pytest.raises(ValueError):
        readers.read_table(spark, path, "xml", "a int")
