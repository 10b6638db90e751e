import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import geo, indices, names, sampling, utm
from sondeframe.operators import aggregates as A
from sondeframe.operators import dataset, grid, joins, splits
from sondeframe.operators import windows as Wn
from sondeframe.plans import registry
from sondeframe.sources import published, readers, sinks
from sondeframe.streaming import fold


def col(spark, expr, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("spei, tz, vhi, want", [(0.0, 0.0, 50.0, 0), (-1.5, 0.0, 50.0, 1), (0.0, 2.5, 50.0, 2), (-1.5, 2.5, 20.0, 3),
    (-1.0, 2.0, 35.0, 0), (None, 3.0, 10.0, 2), (None, None, None, 0)])
def test_classify(spark, spei, tz, vhi, want):
    row = spark.createDataFrame([(spei, tz, vhi)], "a double, b double, c double")
    assert row.select(indices.classify(F.col("a"), F.col("b"), F.col("c"))).first()[0] == want


def test_nan_is_missing(spark):
    row = spark.createDataFrame([(float("nan"),)], "a double")
    assert row.select(indices.nan_to_null(F.col("a"))).first()[0] is None
    assert readers.no_nan(row).first()["a"] is None


def test_weights_from_counts(spark):
    counts = spark.createDataFrame([(0, 19673648), (1, 74015824), (2, 13800359), (3, 30111090)], "cls int, n long")
    got = {r.cls: round(r.weight, 5) for r in A.class_weights(counts).collect()}
    assert got == {0: 1.26526, 1: 0.33631, 2: 1.80375, 3: 0.82668}
    with pytest.raises(ValueError):
        A.class_weights(counts, "other")


def test_gate(spark):
    counts = spark.createDataFrame([(0, 136269), (1, 63254), (2, 6616), (3, 1550)], "cls int, n long")
    r = A.prevalence_gate(counts).first()
    assert round(r.compound_fraction, 5) == 0.00746 and r.verdict == "pass"


def test_split_cells_golden():
    cells = splits.assign_cells(splits.box_cells(C.ROI), splits.box_cells(C.OOD))
    counts = splits.split_documents(cells)[0]["counts"]
    assert counts == {"train": 69, "val": 15, "test": 14, "ood": 154}


def test_no_test_point_near_train(spark):
    cells = splits.assign_cells(splits.box_cells(C.ROI))
    lattice = spark.range(57 * 29).select("id", (22 + (F.col("id") % 57) * 0.25).alias("lon"), (30 + F.floor(F.col("id") / 57) * 0.25).cast("double").alias("lat"))
    out = splits.split_points(lattice, splits.cells_frame(spark, cells)).join(lattice, "id").cache()
    assert joins.pairs_within(out.where("split = 'test'"), out.where("split = 'train'")).count() == 0
    assert out.where("split = 'test'").count() > 0


def test_utm_and_squares(spark):
    p = spark.createDataFrame([(30.947267, 30.686391)], "lon double, lat double")
    e, n = utm.forward(F.col("lon"), F.col("lat"), F.lit(36))
    lon, lat = utm.inverse(e, n, F.lit(36))
    r = p.select(lon.alias("lon"), lat.alias("lat"), utm.mgrs_square(F.col("lon"), F.col("lat")).alias("t"), geo.epsg_of_tile(F.lit("T36RUU")).alias("epsg")).first()
    assert math.isclose(r.lon, 30.947267, abs_tol=1e-9) and math.isclose(r.lat, 30.686391, abs_tol=1e-9)
    assert r.t == "T36RUU" and r.epsg == 32636


def box_frame(spark, *boxes):
    return spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(boxes)], "id int, w double, s double, e double, n double")


def test_cells_and_origins_of_each_row(spark):
    got = {tuple(r) for r in grid.whole_cells(box_frame(spark, C.ROI, (0.5, 0.5, 2.5, 1.4), (0.0, 0.0, 2.0, 1.0))).collect()}
    assert got == {(0, x, y) for x in range(22, 36) for y in range(30, 37)} | {(2, 0, 0), (2, 1, 0)}
    sizes = spark.createDataFrame([(1, 3660, 3660), (2, 224, 500), (3, 223, 900)], "id int, height int, width int")
    got = sorted(tuple(r) for r in grid.patch_origins(sizes).collect())
    assert got == [(1, y, x) for y in range(16) for x in range(16)] + [(2, 0, 0), (2, 0, 1)]


def test_tile_counts(spark):
    roi, ood = (grid.squares_in_boxes(box_frame(spark, b)) for b in (C.ROI, C.OOD))
    assert roi.count() == 160 and ood.join(roi, "tile", "left_anti").count() == 238


def test_square_boxes(spark):
    t = spark.createDataFrame([("T36RUU",), ("T35RPN",)], "tile string")
    zone, east, north = utm.square_origin(F.col("tile"))
    o = {r.tile: r for r in t.select("tile", zone.alias("zone"), east.alias("east"), north.alias("north")).collect()}
    assert (o["T36RUU"].zone, o["T36RUU"].east, o["T36RUU"].north) == (36, 300000.0, 3300000.0)
    boxes = grid.square_boxes(t)
    middle = boxes.select("tile", ((F.col("w") + F.col("e")) / 2).alias("lon"), ((F.col("s") + F.col("n")) / 2).alias("lat"), (F.col("n") - F.col("s")).alias("high"))
    for r in middle.select("tile", "high", utm.mgrs_square(F.col("lon"), F.col("lat")).alias("again")).collect():
        assert r.again == r.tile and 0.85 < r.high < 1.0


def test_squares_reach_the_region(spark):
    w, s, e, n = C.ROI
    rows = grid.squares_in_boxes(box_frame(spark, C.ROI)).collect()
    assert all(r.w < e + 0.2 and r.e > w - 0.2 and r.s < n + 0.2 and r.n > s - 0.2 and 0.85 < r.n - r.s < 1.05 for r in rows)


def test_patch_rows_have_centres(spark):
    px = spark.createDataFrame([("T36RUU", dt.date(2023, 8, 1), "S30", y, x, 5, 0) for y in (0, 230, 449) for x in (0, 225)], "mgrs_tile string, date date, sensor string, y int, x int, red int, fmask int")
    got = {r.sample_id: r for r in grid.patch_rows(px, 450, 448, 300000.0, 3400020.0, 36).collect()}
    assert set(got) == {f"T36RUU_2023-08-01_r{r:02d}c{c:02d}" for r in (0, 1) for c in (0, 1)}
    e, n = utm.forward(F.lit(got["T36RUU_2023-08-01_r01c00"].center_lon), F.lit(got["T36RUU_2023-08-01_r01c00"].center_lat), F.lit(36))
    east, north = col(spark, e), col(spark, n)
    assert abs(east - (300000 + 112.5 * 30)) < 0.2 and abs(north - (3400020 - 336.5 * 30)) < 0.2


def test_unaligned_layers_raise(spark):
    t = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.2, 0.2)], "id int, lat double, lon double")
    grid.require_aligned(t, t)
    with pytest.raises(ValueError):
        grid.require_aligned(t.where("id = 1"), t)


def test_names(spark):
    s = F.lit("HLS.S30.T36RUU.2023213T082611.v2.0")
    assert col(spark, names.scene_date(s)) == dt.date(2023, 8, 1)
    assert col(spark, names.scene_date(F.lit("x.2023000T0"))) is None
    assert col(spark, names.scene_date(F.lit("x.2023366T0"))) == dt.date(2024, 1, 1)
    assert col(spark, names.sample_id(F.lit("T36RUU"), F.lit(dt.date(2023, 8, 1)), F.lit(3), F.lit(11))) == "T36RUU_2023-08-01_r03c11"


def test_cloud_fraction(spark):
    df = spark.createDataFrame([(2,), (0,), (255,), (32,)], "v int")
    assert df.agg(A.cloud_fraction(F.col("v"))).first()[0] == pytest.approx(1 / 3)
    assert df.where("v = 255").agg(A.cloud_fraction(F.col("v"))).first()[0] == 1.0


def test_circular_window(spark):
    m = spark.createDataFrame([(1, 366, 15.0, 0.0, 1), (1, 1, 25.0, 0.0, 1)], "cell int, doy int, mean double, m2 double, n long")
    got = {r.doy: (r.mean, r["std"], r.n) for r in Wn.circular_doy(m, ["cell"], 3).collect()}
    assert got[366] == (20.0, 5.0, 2) and got[1] == (20.0, 5.0, 2) and got[2][0] == 25.0


def test_bilinear_nodes_and_gaps(spark):
    v = spark.createDataFrame([(0, 0, 0.0), (0, 1, 1.0), (1, 0, 0.0), (1, 1, 1.0)], "lat_i int, lon_i int, v double")
    t = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.0, 1.0), (3, 2.0, 0.0)], "id int, lat double, lon double")
    assert {r.id: r.v for r in grid.bilinear(v, t, 0, 1, 2, 0, 1, 2).collect()} == {1: 0.5, 2: 1.0, 3: None}
    assert {r.id: r.v for r in grid.bilinear(v.where("lat_i = 0 or lon_i = 0"), t, 0, 1, 2, 0, 1, 2).collect()} == {1: None, 2: 1.0, 3: None}


def test_hash_rate(spark):
    n = spark.range(4000).select(sampling.keep(F.col("id"), F.lit(0.3)).alias("k")).where("k").count()
    assert abs(n / 4000 - 0.3) < 0.03


def test_append_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("a", "T1", 2020), ("b", "T1", 2020)], "sample_id string, mgrs_tile string, year int")
    path = str(tmp_path / "index")
    assert sinks.append_index(rows, path) == 2 and sinks.append_index(rows.unionByName(rows), path) == 0


def test_stream_fold_equals_batch(spark, tmp_path):
    v = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 13).cast("double").alias("value")).repartition(5)
    want = {r.k: (r.a, r.b) for r in v.groupBy("k").agg(F.min("value").alias("a"), F.max("value").alias("b")).collect()}
    assert {r.k: (r.v_min, r.v_max) for r in fold.fold_min_max(v, ["k"]).collect()} == want
    v.select(F.col("k").alias("sample_id"), "value").write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    for _ in range(2):
        fold.append_new(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert published.read_published(spark, str(tmp_path / "out"), schema).count() == 7


def test_violations_name_the_column(spark):
    row = spark.createDataFrame([("a", 200.0, 30.0, 0.1, 0.9, "delta", "train"), ("b", 30.0, 30.0, 0.1, 0.9, "delta", "train"), ("c", None, 30.0, 0.1, 0.9, "sea", "train")],
        "sample_id string, center_lon double, center_lat double, cloud_pct double, valid_pct double, region string, split string")
    assert {r.sample_id: r.problems for r in dataset.violations(row).collect()} == {"a": ["center_lon"], "c": ["center_lon", "region"]}


def test_meteo_coverage_takes_every_sample_and_channel(spark, tmp_path):
    """A gap in one channel counts, of a customer of any number."""
    spark.createDataFrame([(1,), (2,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 5), 3.0), (2, dt.datetime(2024, 1, 6), None)], "user_id long, ts timestamp, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.sample_id: (r.coverage, r.days) for r in registry.QUERIES["meteo_coverage_all_samples"](spark, str(tmp_path)).collect()}
    assert got == {"1": (round(6 / 540, 6), 90), "2": (0.0, 90)}


def test_all_years_have_windows_and_labels():
    assert all("1996" not in registry.ORACLE[n] for n in ("label_grid_all_years", "one_scene_per_window_all_years", "as_of_label"))
    assert not {"label_grid", "one_scene_per_window", "meteo_coverage", "temporal_leaks"} & set(registry.QUERIES)
