"""100 km squares of boxes: shared boxes, and how often the lattice is projected."""

import random

from pyspark.sql import functions as F

from sondeframe.functions import utm
from sondeframe.operators import grid


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, w double, s double, e double, n double")


def test_boxes_that_share_a_place_get_the_same_squares(spark):
    rng = random.Random(3)
    boxes = [(x, y, x + 0.75, y + 0.5) for x, y in ((rng.uniform(22, 35), rng.uniform(30, 36)) for _ in range(4))] + [(35.7, 31.0, 36.4, 31.0)]
    rows = [(i, *boxes[i % 5]) for i in range(40)] + [(0, *boxes[0]), (1, *boxes[2]), (99, None, 30.0, 23.0, 31.0)]
    lattice = [(k, w - 0.1 + i * 0.05, s - 0.1 + j * 0.05) for k, (w, s, e, n) in enumerate(boxes) for i in range(int((e - w + 0.2) / 0.05 + 1e-6) + 1) for j in range(int((n - s + 0.2) / 0.05 + 1e-6) + 1)]
    at = spark.createDataFrame(lattice, "k int, lon double, lat double").select("k", utm.mgrs_square(F.col("lon"), F.col("lat")).alias("tile")).distinct().collect()
    tiles = {k: {r.tile for r in at if r.k == k} for k in range(5)}
    want = {(i, t) for i in range(40) for t in tiles[i % 5]} | {(1, t) for t in tiles[2]}
    got = grid.squares_in_boxes(frame(spark, rows)).collect()
    assert {(r.id, r.tile) for r in got} == want and len(got) == len(want)


def test_the_lattice_is_laid_over_distinct_boxes_and_projected_once(spark):
    """Before, every box had its own lattice, and a join's filter on NULL held the whole projection as one expression."""
    df = grid.squares_in_boxes(frame(spark, [(i, 30.0, 31.0, 30.75, 31.5) for i in range(50)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "SINH" in x] and "BroadcastHashJoin" not in plan
    lines = plan.splitlines()
    explodes = [i for i, x in enumerate(lines) if "Generate explode(sequence" in x]
    assert explodes and all(any("HashAggregate(keys=[w#" in x for x in lines[i:]) for i in explodes)


def test_projected_gives_the_values_of_forward(spark):
    p = spark.sql("select -180 + id * 7.3 lon, -79 + id * 3.1 lat from range(50)").selectExpr("cast(lon as double) lon", "cast(lat as double) lat")
    zone = utm.zone_of(F.col("lon"))
    e, n = utm.forward(F.col("lon"), F.col("lat"), zone)
    want = {r.lon: tuple(r)[1:] for r in p.select("lon", zone, e, n).collect()}
    assert {r.lon: (r.zone, r.east, r.north) for r in utm.projected(p).collect()} == want
