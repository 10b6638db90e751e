"""Rasters against brute force: tiled composites, daily fields, scene grids, prefix sums, label patches."""

import datetime as dt
import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import names, utm
from sondeframe.operators import grid, patches, prefix, regrid

DAY = dt.date(2020, 1, 1)


def bilinear(px, py, ax, pixels):
    """``pixels[(yi, xi)]`` at a point; None outside the hull or beside a missing corner that weighs anything."""
    fx, fy = (px - ax["x0"]) / ax["dx"], (py - ax["y0"]) / ax["dy"]
    if not (0 <= fx <= ax["nx"] - 1 and 0 <= fy <= ax["ny"] - 1):
        return None
    ix, iy = max(0, min(math.floor(fx), ax["nx"] - 2)), max(0, min(math.floor(fy), ax["ny"] - 2))
    total = 0.0
    for a in (0, 1):
        for b in (0, 1):
            w = ((fy - iy) if a else 1 - fy + iy) * ((fx - ix) if b else 1 - fx + ix)
            if w > 1e-9:
                if pixels.get((iy + a, ix + b)) is None:
                    return None
                total += w * pixels[iy + a, ix + b]
    return total


def sinusoidal(lon, lat):
    return C.SINUSOIDAL_R * math.radians(lon) * math.cos(math.radians(lat)), C.SINUSOIDAL_R * math.radians(lat)


def tile_case(rng):
    t = regrid.SINUSOIDAL_TILE
    axes = {}
    for h, n in ((19, 5), (20, 7), (21, 4)):
        axes[f"h{h}v05"] = {"x0": (h - 18) * t + t / n / 2, "dx": t / n, "nx": n, "y0": 4 * t - t / n / 2, "dy": -t / n, "ny": n}
    # a tile that overlaps two others, so that the maximum over tiles decides
    axes["h20x"] = {"x0": 1.5 * t, "dx": t / 6, "nx": 9, "y0": 3.9 * t, "dy": -t / 8, "ny": 7}
    files, values = [], []
    for tile, ax in axes.items():
        for k in rng.sample(range(0, 700, 16), 9):
            day = DAY + dt.timedelta(k)
            name = f"MOD13Q1.A{day:%Y%j}.{tile}.tif"
            files.append((tile, name, day))
            values += [(name, tile, y, x, rng.choice([rng.randrange(-1500, 9000), rng.randrange(-1500, 9000), rng.randrange(-1500, 9000), -3000])) for y in range(ax["ny"]) for x in range(ax["nx"]) if rng.random() < 0.98]
    targets = [(i, rng.uniform(14, 40), rng.uniform(29, 41)) for i in range(60)]
    return axes, files, values, targets


def test_tile_indicator_matches_brute_force(spark):
    rng = random.Random(5)
    axes, files, values, targets = tile_case(rng)
    dates = [DAY + dt.timedelta(k) for k in range(0, 720, 37)]
    want = {}
    for d in dates:
        for i, lon, lat in targets:
            px, py = sinusoidal(lon, lat)
            found = []
            for tile, ax in axes.items():
                own = [(abs((fd - d).days), name) for t, name, fd in files if t == tile and fd.year == d.year]
                if own:
                    pixels = {(y, x): v for name, _, y, x, v in values if name == min(own)[1] and -2000 <= v <= 10000}
                    v = bilinear(px, py, ax, pixels)
                    found += [v] if v is not None else []
            if found:
                want[d, i] = max(found)
    f = spark.createDataFrame(files, "tile string, file string, day date")
    got = regrid.tile_indicator(
        spark.createDataFrame([(d,) for d in dates], "day date"), f, spark.createDataFrame(values, "file string, tile string, yi int, xi int, v int"),
        spark.createDataFrame([(t, *(a[c] for c in regrid.AXES)) for t, a in axes.items()], "tile string, x0 double, dx double, nx int, y0 double, dy double, ny int"),
        spark.createDataFrame(targets, "id int, lon double, lat double"), "MOD13Q1",
    ).collect()
    assert {(r.day, r.id) for r in got} == set(want) and len(got) == len(want) > 50
    assert all(abs(r.v - want[r.day, r.id]) < 1e-6 for r in got)
    with pytest.raises(ValueError, match="2023"):
        regrid.require_years(spark.createDataFrame([(dt.date(2023, 5, 1),), (DAY,)], "day date"), f)


def test_axes_of_a_tile_name(spark):
    r = spark.createDataFrame([("h20v05",)], "tile string").select(*regrid.sinusoidal_axes(F.col("tile"), F.lit(10))).first()
    t = regrid.SINUSOIDAL_TILE
    assert abs(t - 1111950.5197) < 1e-3 and abs(r.x0 - (2 * t + t / 20)) < 1e-6 and abs(r.y0 - (4 * t - t / 20)) < 1e-6 and r.dy == -r.dx and r.nx == r.ny == 10


def test_field_on_takes_the_nearest_step_of_the_month(spark):
    ax = {"x0": 10.0, "dx": 2.0, "nx": 3, "y0": 40.0, "dy": -1.0, "ny": 3}
    rng = random.Random(2)
    steps = [dt.date(2020, 1, k) for k in (3, 9, 20)] + [dt.date(2020, 2, 1)]
    daily = [(s, y, x, rng.uniform(0, 30)) for s in steps for y in range(3) for x in range(3) if (s.day, y, x) != (9, 0, 0)]
    dates = [dt.date(2020, 1, k) for k in (1, 6, 9, 14, 15, 31)] + [dt.date(2020, 2, 29)]
    targets = [(0, 10.5, 39.5), (1, 14.0, 38.0), (2, 9.9, 39.0), (3, 12.0, 39.0), (4, 13.1, 38.2)]
    pick = {d: min((abs((s - d).days), -s.toordinal(), s) for s in steps if s.month == d.month)[2] for d in dates}
    assert pick[dt.date(2020, 1, 6)] == dt.date(2020, 1, 9)  # of two as near the later
    want = {(d, i): v for d in dates for i, x, y in targets if (v := bilinear(x, y, ax, {(a, b): v for s, a, b, v in daily if s == pick[d]})) is not None}
    df = spark.createDataFrame(daily, "day date, yi int, xi int, v double")
    at = spark.createDataFrame(targets, "id int, lon double, lat double")
    days = lambda ds: spark.createDataFrame([(d,) for d in ds], "day date")
    got = {(r.day, r.id): r.v for r in regrid.field_on(days(dates), df, ax, at).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and (dates[2], 0) not in got
    with pytest.raises(ValueError, match="2020-03"):
        regrid.field_on(days([dt.date(2020, 3, 1)]), df, ax, at)


def test_first_file_that_covers_and_first_valid_tile(spark):
    files = spark.createDataFrame([("b", DAY, DAY + dt.timedelta(30)), ("a", DAY + dt.timedelta(5), DAY + dt.timedelta(5))], "file string, first_day date, last_day date")
    days = spark.createDataFrame([(DAY + dt.timedelta(k),) for k in (4, 5, 5, 31)], "day date")
    assert sorted((r.day - DAY).days * 10 + ord(r.file) for r in regrid.first_cover(days, files).collect()) == [4 * 10 + ord("b"), 5 * 10 + ord("a")]
    tiles = spark.createDataFrame([(2, 0, 0, 7.0), (1, 0, 0, -9.0), (1, 0, 1, 4.0), (2, 0, 1, 8.0), (3, 1, 1, None)], "tile int, yi int, xi int, v double")
    assert {(r.yi, r.xi): r.v for r in regrid.first_valid(tiles, ["yi", "xi"], "tile", -9.0).collect()} == {(0, 0): 7.0, (0, 1): 4.0}


def test_mosaic_regrids_over_the_seam(spark):
    """A point between two tiles' last and first pixels has a value, as tiles are merged before."""
    ax = {"x0": 0.0, "dx": 1000.0, "nx": 4, "y0": 0.0, "dy": 1000.0, "ny": 2}
    tiles = spark.createDataFrame([("d", 1 if x < 2 else 2, y, x, float(10 * x)) for x in range(4) for y in range(2)], "day string, tile int, yi int, xi int, v double")
    lat = math.degrees(500 / C.SINUSOIDAL_R)
    at = spark.createDataFrame([(0, math.degrees(1500 / C.SINUSOIDAL_R / math.cos(math.radians(lat))), lat)], "id int, lon double, lat double")
    (r,) = regrid.matched_mosaic(tiles, ["day"], ax, at).collect()
    assert r.day == "d" and abs(r.v - 15.0) < 1e-9


def test_utm_pixels_and_matched_daily(spark):
    px = regrid.utm_pixels(spark, 400000.0, 3500000.0, 36, 3, 4, 1000.0).collect()
    for r in px:
        lon, lat = utm.inverse(400000 + (r.id % 4 + 0.5) * 1000, 3500000 - (r.id // 4 + 0.5) * 1000, 36, m=math)
        assert abs(r.lon - lon) < 1e-12 and abs(r.lat - lat) < 1e-12
    ax = {"x0": 30.0, "dx": 5.0, "nx": 2, "y0": 30.0, "dy": 5.0, "ny": 2}
    values = spark.createDataFrame([(f, DAY, y, x, v) for f, v in (("m", 1.0), ("m", 3.0), ("a", 9.0)) for y in (0, 1) for x in (0, 1)], "file string, day date, yi int, xi int, v double")
    files = spark.createDataFrame([("m", DAY, DAY), ("z", DAY, DAY)], "file string, first_day date, last_day date")
    got = regrid.matched_daily(values.select("day").distinct(), files, values, ax, spark.createDataFrame([(0, 32.0, 31.0)], "id int, lon double, lat double")).collect()
    assert [(r.file, r.id, round(r.v, 9)) for r in got] == [("m", 0, 2.0)]


# --- windows ------------------------------------------------------------------------------------------------------
X, Y = (30.1, 0.25, 17), (20.05, 0.2, 13)


def window_of(w, s, e, n):
    xs, ys = [i for i in range(X[2]) if w <= X[0] + i * X[1] <= e], [i for i in range(Y[2]) if s <= Y[0] + i * Y[1] <= n]
    if xs and ys:
        return [(y, x) for y in ys for x in xs]
    near = lambda m, a: min(range(a[2]), key=lambda i: (abs(m - (a[0] + i * a[1])), i))
    return [(near((s + n) / 2, Y), near((w + e) / 2, X))]


def test_every_window_decision_matches_brute_force(spark):
    rng = random.Random(7)
    labels = [(DAY + dt.timedelta(k), y, x, rng.choice([0, 0, 0, 1, 2, 3, 255, 255])) for k in range(3) for y in range(Y[2]) for x in range(X[2]) if rng.random() < 0.7]
    labels += labels[:20]  # repeated pixels
    tiles = [("T1", 29.5, 19.5, 33.0, 23.0), ("T2", 30.1, 20.05, 30.6, 20.45), ("T3", 31.0, 21.0, 36.0, 22.2), ("T4", 40.0, 30.0, 41.0, 31.0)]
    sid = names.sample_id(F.col("tile"), F.col("day"), F.col("row"), F.col("col"))
    got = prefix.decide_windows(spark.createDataFrame(tiles, "id string, w double, s double, e double, n double"), spark.createDataFrame(labels, "day date, yi int, xi int, cls int"), X, Y, sid, cells=5).collect()
    held = {}
    for d, y, x, c in labels:
        held.setdefault((d, y, x), []).append(c)
    assert len(got) == 4 * 3 * 25
    kinds = Counter()
    for r in got:
        w, s, e, n = next(t[1:] for t in tiles if t[0] == r.tile)
        dx, dy = (e - w) / 5, (n - s) / 5
        pixels = [c for y, x in window_of(w + r.col * dx, s + r.row * dy, w + (r.col + 1) * dx, s + (r.row + 1) * dy) for c in held.get((r.day, y, x), [])]
        counts = [sum(c == k for c in pixels) for k in range(4)]
        assert [r.n0, r.n1, r.n2, r.n3] == counts
        cls = max((k for k in range(4) if counts[k]), default=None)
        name = f"{r.tile}_{r.day}_r{r.row:02d}c{r.col:02d}"
        u = int(hashlib.sha256(f"{C.SEED}:{name}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.cls == cls and r.sample_id == name and r.kept == (cls is not None and (cls == 3 or u < C.KEEP_PROB[cls]))
        kinds[cls] += 1
    assert len(kinds) == 5


def test_index_windows_hold_the_same_pixels_as_box_pixels(spark):
    rng = random.Random(3)
    boxes = []
    for i in range(200):
        w, s = rng.choice([rng.uniform(29, 35), X[0] + X[1] * rng.randrange(17)]), rng.choice([rng.uniform(19, 23), Y[0] + Y[1] * rng.randrange(13)])
        boxes.append((i, w, s, w + rng.choice([0, 0.1, X[1], 2.3]), s + rng.choice([0, 0.05, Y[1], 1.7])))
    df = spark.createDataFrame(boxes, "id int, w double, s double, e double, n double")
    want = {}
    for r in grid.box_pixels(df, X, Y).collect():
        want.setdefault(r.id, set()).add((r.yi, r.xi))
    named = df.withColumnsRenamed({"w": "cw", "s": "cs", "e": "ce", "n": "cn"})
    got = {r.id: {(y, x) for y in range(r.ya, r.yb + 1) for x in range(r.xa, r.xb + 1)} for r in prefix.index_windows(named, X, Y).collect()}
    assert got == want


def test_windows_never_explode_pixels(spark):
    """Four lookups a window, and prefix windows over one line of a raster."""
    labels = spark.range(400).selectExpr("date_add(date'2020-01-01', cast(id % 2 as int)) day", "cast(id % 13 as int) yi", "cast(id % 17 as int) xi", "cast(id % 4 as int) cls")
    windows = spark.createDataFrame([(i, 0, 12, 0, 16) for i in range(50)], "wid int, ya int, yb int, xa int, xb int")
    out = prefix.window_counts(windows, prefix.prefix_counts(labels, ["day"], 13, 17), ["day"])
    by_day = {d: tuple(labels.where(f"cls = {c} and day = date'{d}'").count() for c in range(4)) for d in ("2020-01-01", "2020-01-02")}
    got = out.collect()
    assert len(got) == 100 and all(tuple(r)[2:] == by_day[str(r.day)] for r in got)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") >= 2 and "Generate explode" in plan and "CartesianProduct" not in plan
    lines = [x.split("Window [")[1] for x in plan.splitlines() if "Window [" in x]
    assert all("[day#" in x and ("yi#" in x.split("[day#")[1] or "xi#" in x.split("[day#")[1]) for x in lines), lines


# --- patches ------------------------------------------------------------------------------------------------------
def test_label_patches_match_brute_force(spark):
    rng = random.Random(1)
    lat, lon = (30.0, 0.05, 70), (28.0, 0.05, 90)
    labels = [(k, y, x, rng.choice([0, 1, 2, 3, 255])) for k in (1, 2) for y in range(70) for x in range(90) if rng.random() < 0.9]
    points = [(i, rng.uniform(28.0, 32.4), rng.uniform(30.0, 33.4), rng.choice([1, 2])) for i in range(25)]
    points += [(90, 27.9, 29.95, 1), (91, 28.0, 60.0, 1), (92, 30.0, 31.0, 3), (93, None, 31.0, 1)]
    p, at = spark.createDataFrame(points, "id int, lon double, lat double, k int"), spark.createDataFrame(labels, "k int, lat_i int, lon_i int, cls int")
    size, res = 12, 2500.0
    held = {(k, y, x): c for k, y, x, c in labels}
    got = {r.id: r for r in patches.label_patches(p, at, ["k"], lat, lon, size, res, block=16).collect()}
    counted = {}
    for r in patches.label_counts(p, at, ["k"], lat, lon, size, res, block=16).collect():
        counted.setdefault(r.id, {})[r.cls] = r.n
    for i, x0, y0, k in points:
        want = []
        if x0 is not None:
            zone = math.floor((x0 + 180) / 6) + 1
            row = spark.range(1).select(*[c.alias(n) for c, n in zip(utm.forward(F.lit(x0), F.lit(y0), F.lit(zone)), "en", strict=True)]).first()
            for y in range(size):
                for x in range(size):
                    a, b = utm.inverse(row.e + (x - (size - 1) / 2) * res, row.n - (y - (size - 1) / 2) * res, zone, m=math)
                    want.append(held.get((k, round((b - lat[0]) / lat[1]), round((a - lon[0]) / lon[1])), 255))
        else:
            want = [255] * size * size
        assert list(got[i].patch) == want and counted[i] == dict(Counter(want)) and got[i].k == k
    assert len({c for c in counted.values() for c in c}) == 5


def test_patches_of_the_reference_size(spark):
    at = spark.createDataFrame([(y, x, (y + x) % 4) for y in range(20) for x in range(20)], "lat_i int, lon_i int, cls int")
    p = spark.createDataFrame([(1, 30.5, 30.5)], "id int, lon double, lat double")
    (r,) = patches.label_patches(p, at, [], (30.0, 0.05, 20), (30.0, 0.05, 20)).collect()
    assert len(r.patch) == 224 * 224 and set(r.patch) <= {0, 1, 2, 3}
    assert sum(x.n for x in patches.label_counts(p, at, [], (30.0, 0.05, 20), (30.0, 0.05, 20)).collect()) == 224 * 224
