"""Mergeable moments and published appends."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sondeframe.operators import aggregates as A
from sondeframe.operators import windows as Wn
from sondeframe.sources import published, sinks
from sondeframe.streaming import fold

OFFSET = 1e9


def values(n=4000, keys=2, seed=3):
    rng = random.Random(seed)
    return [(rng.randrange(keys), rng.choice([1, 2, 40, 200, 360, 366]), OFFSET + rng.gauss(0, 0.5)) for _ in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_merged_moments_keep_their_digits(spark, parts):
    rows = values()
    df = spark.createDataFrame([(k, d, v, i % 9) for i, (k, d, v) in enumerate(rows)], "cell int, doy int, value double, batch int").repartition(parts)
    states = df.groupBy("cell", "doy", "batch").agg(*A.moments(F.col("value")))
    got = {(r.cell, r.doy): r for r in A.merge_moments(states, ["cell", "doy"]).collect()}
    for key in {(k, d) for k, d, _ in rows}:
        own = [v - OFFSET for k, d, v in rows if (k, d) == key]
        assert got[key].n == len(own) and abs(got[key]["mean"] - OFFSET - statistics.fmean(own)) < 1e-6
        assert abs(math.sqrt(got[key].m2 / len(own)) - statistics.pstdev(own)) < 1e-6
    naive = df.groupBy("cell", "doy").agg((F.sum(F.col("value") ** 2) / F.count("*") - F.avg("value") ** 2).alias("var"))
    assert max(abs(r["var"] - 0.25) for r in naive.collect()) > 1  # what E[x^2] - E[x]^2 makes of the same rows


def test_merged_moments_equal_stddev_pop(spark):
    df = spark.createDataFrame(values(500), "cell int, doy int, value double").withColumn("value", F.col("value") - OFFSET)
    got = A.merge_moments(A.doy_moments(df, ["cell"], F.col("doy"), F.col("value")), ["cell"]).select("cell", F.sqrt(F.col("m2") / F.col("n")).alias("s"), "mean")
    want = df.groupBy("cell").agg(F.stddev_pop("value").alias("w"), F.avg("value").alias("m"))
    assert all(abs(r.s - r.w) < 1e-12 and abs(r["mean"] - r.m) < 1e-12 for r in got.join(want, "cell").collect())
    nulls = spark.createDataFrame([(1, 5, None), (1, 5, 2.0), (2, 5, None)], "cell int, doy int, value double")
    assert [tuple(r) for r in A.merge_moments(A.doy_moments(nulls, ["cell"], F.col("doy"), F.col("value")), ["cell", "doy"]).collect()] == [(1, 5, 1, 2.0, 0.0)]


@pytest.mark.parametrize("window", [1, 3, 31, 101])
def test_circular_pooling_matches_brute_force_at_an_offset(spark, window):
    rows = values()
    df = spark.createDataFrame(rows, "cell int, doy int, value double")
    got = {(r.cell, r.doy): r for r in Wn.circular_doy(A.doy_moments(df, ["cell"], F.col("doy"), F.col("value")), ["cell"], window).collect()}
    half, want = window // 2, {}
    for k in (0, 1):
        for doy in range(1, 367):
            own = [v - OFFSET for c, d, v in rows if c == k and min((d - doy) % 366, (doy - d) % 366) <= half]
            if own:
                want[k, doy] = (len(own), statistics.fmean(own), statistics.pstdev(own))
    assert set(got) == set(want)
    for key, (n, mean, std) in want.items():
        assert got[key].n == n and abs(got[key]["mean"] - OFFSET - mean) < 1e-6 and abs(got[key]["std"] - std) < 1e-6


def test_circular_pooling_has_no_fan_out(spark):
    states = spark.range(366 * 5).selectExpr("cast(id % 5 as int) cell", "cast(id % 366 + 1 as int) doy", "1L n", "1.0D mean", "0.0D m2")
    out = Wn.circular_doy(states, ["cell"], 31)
    assert out.count() == 5 * 366
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1  # the year of each key, not 31 rows for each state


# --- published batches --------------------------------------------------------------------------------------------
SCHEMA = "sample_id string, mgrs_tile string, year int"


def test_a_crash_before_publishing_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", "T1", 2020), ("b", "T2", 2021)], SCHEMA)
    path = f"file://{tmp_path}/index"
    name = published.write_batch(rows, path, ("mgrs_tile", "year"))  # and here the driver dies
    assert published.published(spark, path) == {} and sinks.read_index(spark, path, rows.schema).count() == 0
    assert sinks.append_index(rows, path, batch_id="run 1/2") == 2
    assert sorted(map(tuple, sinks.read_index(spark, path, rows.schema).collect())) == [("a", "T1", 2020), ("b", "T2", 2021)]
    assert name not in published.published(spark, path).values() and list(published.published(spark, path)) == ["run 1/2"]


def test_a_replay_adds_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    one, two = (spark.createDataFrame([(f"{k}{i}", "T1", 2020) for i in range(3)], SCHEMA) for k in "ab")
    assert published.publish(one, path, "b1") == 3 and published.publish(two, path, "b1") is None
    assert published.publish(two, path, "b2") == 3 and published.publish(one.where("false"), path, "b3") == 0
    assert published.read_published(spark, path, one.schema).count() == 6
    assert sinks.append_index(one.unionByName(two), path) == 0


def test_index_columns_keep_their_types_over_batches(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    for k in range(3):
        sinks.append_index(spark.createDataFrame([(f"s{k}", "001", 2020 + k), ("s0", "001", 2020)], SCHEMA), path)
    got = sinks.read_index(spark, path, spark.createDataFrame([], SCHEMA).schema)
    assert dict(got.dtypes) == {"sample_id": "string", "mgrs_tile": "string", "year": "int"}
    assert sorted(map(tuple, got.collect())) == [("s0", "001", 2020), ("s1", "001", 2021), ("s2", "001", 2022)]


def test_streamed_appends_survive_a_replay(spark, tmp_path):
    """The stream's own checkpoint is lost after a published micro-batch: the replay adds nothing, new files go on."""
    schema = "sample_id string, v int"
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], schema)
    df.coalesce(1).write.parquet(source)
    fold.append_new(spark, source, df.schema, target, f"file://{tmp_path}/ck")
    first = published.published(spark, target)
    spark.createDataFrame([("b", 9), ("c", 3)], schema).coalesce(1).write.mode("append").parquet(source)
    fold.append_new(spark, source, df.schema, target, f"file://{tmp_path}/ck")
    fold.append_new(spark, source, df.schema, target, f"file://{tmp_path}/ck2")  # all files again
    rows = published.read_published(spark, target, df.schema).collect()
    assert sorted(r.sample_id for r in rows) == ["a", "b", "c"] and {r.v for r in rows if r.sample_id == "b"} == {2}
    assert first.items() <= published.published(spark, target).items() and len(first) == 1


def test_folded_state_is_mergeable(spark, tmp_path):
    df = spark.createDataFrame([(k, v) for k, _, v in values(600)], "cell int, value double").repartition(5)
    got = {r.cell: r for r in fold.fold_moments(df, ["cell"]).collect()}
    for r in df.groupBy("cell").agg(F.count("*").alias("n"), F.stddev_pop("value").alias("s")).collect():
        assert got[r.cell].n == r.n and abs(math.sqrt(got[r.cell].m2 / r.n) - r.s) < 1e-6
