"""Label patches around points: label blocks meet points by a block key, pixels only exist inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import utm
from sondeframe.operators.joins import sized

#: Edge of a label block, in label pixels.
BLOCK = 32
#: Blocks (about a kilobyte each) up to which they are broadcast.
BROADCAST_BLOCKS = 20_000


def label_blocks(labels: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """``labels(keys, lat_i, lon_i, cls)`` as ``(keys, by, bx, cells)``, one byte a pixel, 255 where there is none."""
    size = block * block
    at = (F.col("lat_i") % block) * block + F.col("lon_i") % block
    one = labels.select(*keys, F.floor(F.col("lat_i") / block).cast("int").alias("by"), F.floor(F.col("lon_i") / block).cast("int").alias("bx"), at.cast("int").alias("at"), F.col("cls").cast("int").alias("cls"))
    # repeated pixels: the largest class that isn't nodata
    one = one.groupBy(*keys, "by", "bx", "at").agg(F.max(F.when(F.col("cls") != C.NODATA, F.col("cls"))).alias("cls"))
    held = one.groupBy(*keys, "by", "bx").agg(F.map_from_entries(F.collect_list(F.struct("at", F.coalesce("cls", F.lit(C.NODATA))))).alias("_m"))  # block * block at most
    hexed = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.lpad(F.hex(F.coalesce(F.try_element_at("_m", i), F.lit(C.NODATA))), 2, "0"))
    return held.select(*keys, "by", "bx", F.unhex(F.array_join(hexed, "")).alias("cells"))


def _met(points: DataFrame, labels: DataFrame, keys: list[str], lat, lon, size: int, res: float, block: int) -> DataFrame:
    """``(id, keys, zone, east, north, blocks)``: each point in UTM with the label blocks that its square may touch.

    Those are the blocks under a box that holds the square, and a margin of one pixel; one to four as a rule.
    """
    zone = utm.zone_of(F.col("lon"))
    e, n = utm.forward(F.col("lon"), F.col("lat"), zone)
    # A degree of latitude has 110,574 m at least; turned in any way, a square reaches 2 ** 0.5 of its half edge.
    high = size / 2 * res * 2**0.5 / 110_000
    wide = high / F.cos(F.radians(F.least(F.abs("lat") + high, F.lit(89.0))))
    p = points.select("id", *keys, zone.alias("zone"), e.alias("east"), n.alias("north"), "lon", "lat", wide.alias("_wide"))

    def span(low, up, axis: tuple[float, float, int]):
        first, step, count = axis
        a = F.greatest(F.floor((low - first) / step) - 1, F.lit(0).cast("long"))
        b = F.least(F.ceil((up - first) / step) + 1, F.lit(count - 1).cast("long"))
        return F.when(a <= b, F.sequence(F.floor(a / block), F.floor(b / block))).otherwise(F.array().cast("array<bigint>"))

    own = ["id", *keys, "zone", "east", "north"]
    p = p.select(*own, F.explode_outer(span(F.col("lon") - F.col("_wide"), F.col("lon") + F.col("_wide"), lon)).alias("bx"), span(F.col("lat") - high, F.col("lat") + high, lat).alias("_by"))
    p = p.select(*own, F.col("bx").cast("int").alias("bx"), F.explode_outer("_by").alias("by")).withColumn("by", F.col("by").cast("int"))
    met = p.join(sized(label_blocks(labels, keys, block), BROADCAST_BLOCKS), [*keys, "by", "bx"], "left")
    return met.groupBy(*own).agg(F.collect_list(F.when(F.col("cells").isNotNull(), F.struct("by", "bx", "cells"))).alias("blocks"))


def _made(met: DataFrame, keys: list[str], lat, lon, size: int, res: float, block: int, pack, schema: str, names: list[str]) -> DataFrame:
    """Makes each square's pixels inside a task; ``pack`` turns some patches into columns and the row that each entry belongs to."""
    steps, width = (np.arange(size) - (size - 1) / 2) * res, len(keys) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # 64 patches of some 50 KB exist at a time
                part = batch.slice(at, 64)
                zones, easts, norths, blocks = (part.column(width + i).to_pylist() for i in range(4))
                row, columns = pack([_patch(z, x, y, b, steps, lat, lon, block) for z, x, y, b in zip(zones, easts, norths, blocks, strict=True)])
                yield pa.RecordBatch.from_arrays([*(c.take(row) for c in part.columns[:width]), *columns], [*part.schema.names[:width], *names])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.select("id", *keys).schema)
    # Rows of some kilobytes become much work: spread them in a stated number of tasks, which isn't coalesced by bytes.
    spark = met.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return met.select("id", *keys, "zone", "east", "north", "blocks").repartition(tasks, "id").mapInArrow(run, f"{own}, {schema}")


def label_patches(
    points: DataFrame, labels: DataFrame, keys: list[str], lat: tuple[float, float, int], lon: tuple[float, float, int],
    size: int = C.PATCH, res: float = 30.0, block: int = BLOCK,
) -> DataFrame:
    """``(id, keys, patch)``: the nearest label of every pixel of a north-up square in UTM around each ``points(id, lon, lat, keys)``.

    ``patch`` holds size * size bytes by rows from the north, 255 without a source pixel.  A
    label axis is (first centre, step, count); of two centres as near the even index counts.
    A point is one row until a task makes its pixels.
    """
    met = _met(points, labels, keys, lat, lon, size, res, block)
    pack = lambda patches: (pa.array(range(len(patches)), pa.int64()), [pa.array([x.tobytes() for x in patches], pa.binary())])
    return _made(met, keys, lat, lon, size, res, block, pack, "patch binary", ["patch"])


def label_counts(
    points: DataFrame, labels: DataFrame, keys: list[str], lat: tuple[float, float, int], lon: tuple[float, float, int],
    size: int = C.PATCH, res: float = 30.0, block: int = BLOCK,
) -> DataFrame:
    """``(id, keys, cls, n)`` of the same squares: a row for each class that occurs.

    How many pixels of a square have each label pixel as their nearest depends on its place
    alone, so that is counted once a place; classes are looked up after that.  ``block`` has
    no effect here, as no label block is gathered.
    """
    sites = points.select("id", *keys, "lon", "lat").distinct()
    made = _place_cells(points, lat, lon, size, res).select(F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), "cells")
    met = sites.join(made.hint("merge"), sites["lon"].eqNullSafe(made["_lon"]) & sites["lat"].eqNullSafe(made["_lat"]))
    each = met.select("id", *keys, "lon", "lat", F.inline("cells"))
    # repeated pixels: the largest class that isn't nodata
    one = labels.groupBy(*keys, "lat_i", "lon_i").agg(F.max(F.when(F.col("cls") != C.NODATA, F.col("cls").cast("int"))).alias("cls"))
    found = each.join(sized(one), [*keys, "lat_i", "lon_i"], "left").withColumn("cls", F.coalesce("cls", F.lit(C.NODATA)))
    return found.groupBy("id", *keys, "lon", "lat", "cls").agg(F.sum("n").alias("n")).select("id", *keys, "cls", "n")


def _place_cells(points: DataFrame, lat, lon, size: int, res: float) -> DataFrame:
    """``(lon, lat, cells)`` of each distinct place: the label pixels of its square with their number of pixels, NULL indices for those outside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _Counter(lat, lon, size, res)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                zone, east, north = (part.column(2 + i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(3))
                rows = count(zone, east, north)
                flat = [c for r in rows for c in r]
                y, x = (pa.array([c[i] for c in flat], pa.int32()) for i in (0, 1))
                cells = pa.StructArray.from_arrays([y, x, pa.array([c[2] for c in flat], pa.int64())], ["lat_i", "lon_i", "n"])
                ends = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(ends, cells)], ["lon", "lat", "cells"])

    zone = utm.zone_of(F.col("lon"))
    e, n = utm.forward(F.col("lon"), F.col("lat"), zone)
    spark = points.sparkSession
    # As in _made: small rows, much work, so the number of tasks is stated.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    places = points.select("lon", "lat").repartition(tasks, "lon", "lat").distinct()
    placed = places.select("lon", "lat", zone.alias("zone"), e.alias("east"), n.alias("north"))
    return placed.mapInArrow(run, "lon double, lat double, cells array<struct<lat_i: int, lon_i: int, n: long>>")


class _Counter:
    """Pixels of squares by their nearest label pixel, the same as by projecting each pixel.

    Longitude and latitude are smooth over a square, so they are interpolated from NODES by
    NODES projected points.  Pixels that come within ``TOL`` of the border of two label
    pixels are projected themselves; a square whose interpolation is off by more than a
    hundredth of that at the probed points, corners among them, or that holds many borders, is projected whole.
    """

    NODES, TOL, BORDERS = 5, 1e-6, 64

    def __init__(self, lat, lon, size: int, res: float):
        self.axes, self.size, self.steps = (lon, lat), size, (np.arange(size) - (size - 1) / 2) * res
        half = max((size - 1) / 2 * res, res)
        nodes = np.cos((2 * np.arange(self.NODES) + 1) * np.pi / (2 * self.NODES))
        self.nodes, self.probes = nodes * half, np.array([-1.0, -0.55, 0.1, 0.8, 1.0]) * half

        def weights(at: np.ndarray) -> np.ndarray:
            t = at / half
            return np.stack([np.prod([(t - m) / (k - m) for m in nodes if m != k], axis=0) for k in nodes], axis=1)

        self.dense, self.sparse = weights(self.steps), weights(self.probes)

    def _exact(self, zone, east, north) -> tuple[np.ndarray, np.ndarray]:
        return tuple((v - a[0]) / a[1] for v, a in zip(utm.inverse(east, north, zone, m=np), self.axes, strict=True))

    def __call__(self, zone: np.ndarray, east: np.ndarray, north: np.ndarray) -> list[list[tuple]]:
        z, e, n = (v[:, None, None] for v in (zone, east, north))
        grid = lambda at: self._exact(z, e + at[None, None, :], n - at[None, :, None])
        knots, probed = grid(self.nodes), grid(self.probes)
        off = [np.abs(self.sparse @ k @ self.sparse.T - p).max(axis=(1, 2)) for k, p in zip(knots, probed, strict=True)]
        good = (off[0] < self.TOL / 100) & (off[1] < self.TOL / 100)  # false for NaN too
        out = []
        for i in range(len(zone)):
            if np.isnan(zone[i]) or np.isnan(east[i]):
                out.append([(None, None, self.size**2)])
            else:
                out.append((good[i] and self._by_borders(zone[i], east[i], north[i], knots[0][i], knots[1][i])) or self._whole(zone[i], east[i], north[i]))
        return out

    def _by_borders(self, zone, east, north, *knots) -> list[tuple] | None:
        firsts, above = [], []
        for a, k in enumerate(knots):
            f = self.dense @ k @ self.dense.T
            low, high = np.floor(f.min() - self.TOL + 0.5), np.floor(f.max() + self.TOL + 0.5)
            if high - low > self.BORDERS:
                return None
            masks = [None]  # everything
            for border in np.arange(low, high) + 0.5:
                mask, sure = f > border - self.TOL, f > border + self.TOL
                if np.count_nonzero(mask) != np.count_nonzero(sure):
                    r, c = np.nonzero(mask & ~sure)
                    mask[r, c] = np.rint(self._exact(zone, east + self.steps[c], north - self.steps[r])[a]) > border
                masks.append(mask)
            firsts.append(int(low))
            above.append(masks)
        at_least = np.zeros((len(above[1]) + 1, len(above[0]) + 1), np.int64)
        for j, y in enumerate(above[1]):
            for i, x in enumerate(above[0]):
                at_least[j, i] = self.size**2 if x is None and y is None else np.count_nonzero(x if y is None else y if x is None else x & y)
        n = at_least[:-1, :-1] - at_least[1:, :-1] - at_least[:-1, 1:] + at_least[1:, 1:]
        y, x = np.nonzero(n)
        return self._named(y + firsts[1], x + firsts[0], n[y, x])

    def _whole(self, zone, east, north) -> list[tuple]:
        x, y = (np.rint(v).astype(np.int64).ravel() for v in self._exact(zone, east + self.steps[None, :], north - self.steps[:, None]))
        pairs, n = np.unique(np.stack([y, x]), axis=1, return_counts=True)
        return self._named(pairs[0], pairs[1], n)

    def _named(self, y, x, n) -> list[tuple]:
        inside = (x >= 0) & (x < self.axes[0][2]) & (y >= 0) & (y < self.axes[1][2])
        rows = list(zip(y[inside].tolist(), x[inside].tolist(), n[inside].tolist(), strict=True))
        outside = int(n[~inside].sum())
        return rows + [(None, None, outside)] if outside else rows


def patch_pixels(patches: DataFrame, size: int = C.PATCH) -> DataFrame:
    """``(id, y, x, cls)`` of ``patches(id, patch)``: a row a pixel, for array stores."""
    byte = F.conv(F.hex(F.substring("patch", F.col("k") + 1, 1)), 16, 10).cast("int")
    each = patches.select("id", "patch", F.explode(F.sequence(F.lit(0), F.lit(size * size - 1))).alias("k"))
    return each.select("id", F.floor(F.col("k") / size).alias("y"), (F.col("k") % size).cast("long").alias("x"), byte.alias("cls"))


def _patch(zone, east, north, blocks, steps, lat, lon, block: int) -> np.ndarray:
    """The classes of one square."""
    if zone is None or east is None:
        return np.full((len(steps), len(steps)), C.NODATA, np.uint8)
    x, y = utm.inverse(east + steps[None, :], north - steps[:, None], zone, m=np)
    xi, yi = np.rint((x - lon[0]) / lon[1]).astype(np.int64), np.rint((y - lat[0]) / lat[1]).astype(np.int64)
    out = np.full(xi.shape, C.NODATA, np.uint8)
    inside = (xi >= 0) & (xi < lon[2]) & (yi >= 0) & (yi < lat[2])
    for b in blocks:
        cells = np.frombuffer(b["cells"], np.uint8).reshape(block, block)
        own = inside & (xi // block == b["bx"]) & (yi // block == b["by"])
        out[own] = cells[yi[own] % block, xi[own] % block]
    return out
