"""Label pixels of a square by interpolated borders, against every pixel projected."""

import random

import numpy as np
import pytest

from sondeframe.functions import utm
from sondeframe.operators import patches

LAT, LON = (30.0, 0.05, 140), (22.0, 0.05, 280)


def brute(counter, zone, east, north):
    x, y = utm.inverse(east + counter.steps[None, :], north - counter.steps[:, None], zone, m=np)
    out = {}
    for lat, lon in zip(y.ravel(), x.ravel(), strict=True):
        yi, xi = round((lat - counter.axes[1][0]) / counter.axes[1][1]), round((lon - counter.axes[0][0]) / counter.axes[0][1])
        key = (yi, xi) if 0 <= xi < counter.axes[0][2] and 0 <= yi < counter.axes[1][2] else (None, None)
        out[key] = out.get(key, 0) + 1
    return out


@pytest.mark.parametrize(("lat", "lon", "size", "res"), [(LAT, LON, 60, 110.0), (LAT, LON, 7, 2500.0), ((30.0, -0.05, 100), (22.0, 0.002, 7000), 40, 30.0), (LAT, LON, 1, 30.0), ((-90.0, 2.0, 91), (-180.0, 2.0, 180), 50, 20000.0)])
def test_counts_are_those_of_projected_pixels(lat, lon, size, res):
    rng = random.Random(size)
    counter = patches._Counter(lat, lon, size, res)
    at = [(float(rng.choice([34, 35, 36])), rng.uniform(200000, 800000), rng.choice([rng.uniform(3300000, 4100000), rng.uniform(0, 9300000)])) for _ in range(25)]
    at += [(36.0, 500000.0, 3500000.0), (float("nan"), 500000.0, 3500000.0), (36.0, float("nan"), 1.0)]
    got = counter(*map(np.array, zip(*at, strict=True)))
    for place, rows in zip(at, got, strict=True):
        want = {(None, None): size * size} if np.isnan(place).any() else brute(counter, *place)
        assert {r[:2]: r[2] for r in rows} == want and len(rows) == len(want)


def test_pixels_on_a_border_are_projected():
    """Columns of pixels on the central meridian lie on a border of label pixels: half to even, as for each pixel alone."""
    counter = patches._Counter((30.0, 0.05, 140), (32.975, 0.05, 20), 9, 30.0)  # borders at 33 degrees, the centre of zone 36
    (rows,) = counter(np.array([36.0]), np.array([500000.0]), np.array([3500000.0]))
    assert {r[:2]: r[2] for r in rows} == brute(counter, 36.0, 500000.0, 3500000.0)


def test_a_square_projects_few_points(monkeypatch):
    """Before, each of the 50,176 pixels of a square was projected."""
    seen, inverse = [], utm.inverse
    monkeypatch.setattr(patches.utm, "inverse", lambda e, n, *a, **k: seen.append(np.broadcast(e, n).size) or inverse(e, n, *a, **k))
    counter = patches._Counter(LAT, LON, 224, 30.0)
    rng = np.random.default_rng(1)
    rows = counter(np.full(50, 36.0), rng.uniform(3e5, 7e5, 50), rng.uniform(3.4e6, 4e6, 50))
    assert sum(seen) < 50 * 100 and all(sum(r[2] for r in x) == 224 * 224 for x in rows)


def test_equal_places_are_counted_once_and_equal_rows_too(spark):
    points = [(1, 30.5, 31.0, 1), (2, 30.5, 31.0, 1), (3, 30.5, 31.0, 2), (3, 30.5, 31.0, 2), (4, None, 31.0, 1), (5, 30.5, 31.0, None), (6, 0.0, 0.0, 1)]
    p = spark.createDataFrame(points, "id int, lon double, lat double, k int")
    labels = spark.sql("select 1 k, cast(id / 280 as int) lat_i, cast(id % 280 as int) lon_i, cast(id % 3 as int) cls from range(39200)")
    assert patches._place_cells(p, LAT, LON, 224, 30.0).count() == 3
    got = {}
    for r in patches.label_counts(p, labels, ["k"], LAT, LON).collect():
        got.setdefault((r.id, r.k), {})[r.cls] = r.n
    whole = {255: 224 * 224}
    assert got[1, 1] == got[2, 1] and sum(got[1, 1].values()) == 224 * 224 and 255 not in got[1, 1]
    assert got[3, 2] == got[4, 1] == got[5, None] == got[6, 1] == whole
