"""Windows of tiles that share a box, or have two, are counted once for each distinct box."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sondeframe.functions import names
from sondeframe.operators import prefix

X, Y = (22.025, 0.05, 60), (30.025, 0.05, 40)


def case(spark):
    rng = random.Random(5)
    boxes = [(22.0, 30.0, 22.75, 30.5), (22.3, 30.2, 23.4, 31.1), (24.7, 31.6, 25.2, 32.3)]
    tiles = [(f"t{i}", *boxes[i % 3]) for i in range(60)] + [("two", *boxes[0]), ("two", *boxes[1]), ("same", *boxes[2]), ("same", *boxes[2]), ("none", None, 1.0, 2.0, 3.0), (None, *boxes[0])]
    labels = [(dt.date(2020 + y, 1, 1), rng.randrange(40), rng.randrange(60), rng.choice([0, 0, 1, 2, 3, 255])) for y in range(3) for _ in range(1500)]
    return spark.createDataFrame(tiles, "id string, w double, s double, e double, n double"), spark.createDataFrame(labels, "day date, yi int, xi int, cls int")


def decided(spark):
    tiles, labels = case(spark)
    return prefix.decide_windows(tiles, labels, X, Y, names.sample_id(F.col("tile"), F.col("day"), F.col("row"), F.col("col")), cells=4)


def test_shared_and_double_boxes_match_windows_counted_one_by_one(spark):
    tiles, labels = case(spark)
    boxes = tiles.distinct()
    at = prefix.index_windows(prefix.box_cells(boxes, 4), X, Y)
    px = labels.join(at, (F.col("yi") >= F.col("ya")) & (F.col("yi") <= F.col("yb")) & (F.col("xi") >= F.col("xa")) & (F.col("xi") <= F.col("xb")))
    want = {(r.id, r.day, r.row, r.col): tuple(r)[4:] for r in px.groupBy("id", "day", "row", "col").agg(*[F.count_if(F.col("cls") == c) for c in range(4)]).collect()}
    got = {(r.tile, r.day, r.row, r.col): (r.n0, r.n1, r.n2, r.n3) for r in decided(spark).collect()}
    assert len(got) == 64 * 3 * 16 and all(got[k] == want.get(k, (0, 0, 0, 0)) for k in got) and set(want) <= set(got)


def test_counts_are_made_once_a_distinct_box_and_met_without_a_broadcast(spark):
    """Before, each tile brought its own windows: 64 tiles times 16 cells times 3 dates in place of those of 5 sets of boxes."""
    tiles, labels = case(spark)
    named, held = prefix._shaped_counts(tiles, labels, X, Y, 4)
    assert named.count() == 64 and held.groupBy("_boxes").count().count() == 5 and held.count() == 5 * 16 * 3
    last = decided(spark)._jdf.queryExecution().executedPlan().toString().split("+- ", 3)
    assert "SortMergeJoin" in last[1] + last[2] + last[3][:400]
