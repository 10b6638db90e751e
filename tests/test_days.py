"""Event-time days by a stream, against the batch aggregate, over restarts and late rows."""

import datetime as dt
import random

from sondeframe.sources import published
from sondeframe.streaming import fold

SCHEMA = "cell int, ts timestamp, value double"
T0 = dt.datetime(2024, 3, 1)


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def days(rows):
    out = {}
    for cell, ts, v in rows:
        if v is not None:
            out.setdefault((cell, ts.date()), []).append(v)
    return {k: (len(v), min(v), max(v), round(sum(v) / len(v), 9)) for k, v in out.items()}


def shown(spark, target, schema):
    return {(r.cell, r.day): (r.n, r.low, r.high, round(r["mean"], 9)) for r in published.read_published(spark, target, schema).collect()}


def test_late_rows_within_the_bound_count_and_a_restart_goes_on(spark, tmp_path):
    rng = random.Random(3)
    source, target, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))
    hours = [(c, T0 + dt.timedelta(hours=h, minutes=rng.randrange(60)), float(rng.randrange(100))) for h in range(24 * 8) for c in (0, 1)]
    late = [r for r in hours if rng.random() < 0.1]  # arrive with the next file, at most two days after
    parts = [[r for r in hours if r not in late and (r[1] - T0).days // 2 == k] + [r for r in late if (r[1] - T0).days // 2 == k - 1] for k in range(5)]
    schema = spark.createDataFrame([], SCHEMA).schema
    out = fold.daily_windows(spark.createDataFrame([], SCHEMA), ["cell"]).schema
    run = lambda: fold.stream_days(spark, source, schema, ["cell"], target, checkpoint, late="4 days")
    for part in parts[:3]:
        put(spark, source, part)
    run()
    first = shown(spark, target, out)
    run()  # nothing new
    assert shown(spark, target, out) == first and 0 < len(first)
    for part in parts[3:]:
        if part:
            put(spark, source, part)
    put(spark, source, [(0, T0 + dt.timedelta(days=30), 1.0)])  # moves the watermark past all of it
    run()
    got = shown(spark, target, out)
    assert got == days(hours) and first.items() <= got.items()


def test_rows_beyond_the_bound_are_left_out(spark, tmp_path):
    source, target, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))
    put(spark, source, [(0, T0, 1.0), (0, T0 + dt.timedelta(days=5), 2.0)])
    put(spark, source, [(0, T0 + dt.timedelta(days=9), 3.0)])
    put(spark, source, [(0, T0 + dt.timedelta(hours=3), 99.0), (0, T0 + dt.timedelta(days=20), 4.0)])
    schema = spark.createDataFrame([], SCHEMA).schema
    fold.stream_days(spark, source, schema, ["cell"], target, checkpoint)
    got = shown(spark, target, fold.daily_windows(spark.createDataFrame([], SCHEMA), ["cell"]).schema)
    assert got == {(0, (T0 + dt.timedelta(days=k)).date()): (1, v, v, v) for k, v in ((0, 1.0), (5, 2.0), (9, 3.0))}


def test_batch_days_equal_the_stream_s_rule(spark):
    rows = [(0, T0, 1.0), (0, T0 + dt.timedelta(hours=23, minutes=59), 3.0), (0, T0 + dt.timedelta(days=1), 5.0), (1, T0, None)]
    got = {(r.cell, r.day): (r.n, r.low, r.high) for r in fold.daily_windows(spark.createDataFrame(rows, SCHEMA), ["cell"]).collect()}
    assert got == {(0, T0.date()): (2, 1.0, 3.0), (0, (T0 + dt.timedelta(days=1)).date()): (1, 5.0, 5.0), (1, T0.date()): (0, None, None)}
