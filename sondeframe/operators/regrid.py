"""Bilinear regridding of many files at once: axes by key, dates picked by file, tiles merged.

Rasters are long rows ``(keys, yi, xi, v)``.  A target's four corners and weights
depend on the axes only, so they are made once for all files and dates; the values are
scanned once and meet them by an equi-join on (keys, yi, xi).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import geo, indices, utm
from sondeframe.operators.joins import nearest_date, sized

#: Weights up to this are zero but for rounding: a target on a node takes the node alone.
TINY = 1e-9
AXES = ("x0", "dx", "nx", "y0", "dy", "ny")
SINUSOIDAL_TILE = 2 * math.pi * C.SINUSOIDAL_R / 36  # edge of a 10 degree tile in metres


def placed(targets: DataFrame, axes: dict[str, float]) -> DataFrame:
    """``targets(id, px, py)`` with one set of axes for all."""
    return targets.select("id", "px", "py", *[F.lit(axes[a]).alias(a) for a in AXES])


def routed(targets: DataFrame, axes: DataFrame, cell: float) -> DataFrame:
    """``targets(id, px, py)`` with the axes of each tile whose pixel centres surround them.

    ``axes`` has one row ``(tile, x0, dx, nx, y0, dy, ny)`` for each tile (first pixel
    centre, step, count; steps may be negative).  Tiles are spread over the square cells of
    edge ``cell`` that they meet and found by an equi-join, so any number of tiles goes.
    """
    ends = lambda o, d, n: (F.col(o), F.col(o) + (F.col(n) - 1) * F.col(d))
    (xa, xb), (ya, yb) = ends("x0", "dx", "nx"), ends("y0", "dy", "ny")
    span = lambda a, b: F.explode(F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell)))
    tiles = axes.withColumn("_cx", span(xa, xb)).withColumn("_cy", span(ya, yb))
    at = targets.select("id", "px", "py", F.floor(F.col("px") / cell).alias("_cx"), F.floor(F.col("py") / cell).alias("_cy"))
    inside = F.col("px").between(F.least(xa, xb), F.greatest(xa, xb)) & F.col("py").between(F.least(ya, yb), F.greatest(ya, yb))
    return at.join(tiles, ["_cx", "_cy"]).where(inside).drop("_cx", "_cy")


def corners(at: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, id, need, yi, xi, w)``: the corners that weigh anything for each placed target, and their number.

    Targets outside the hull of pixel centres have none.
    """
    fx, fy = (F.col("px") - F.col("x0")) / F.col("dx"), (F.col("py") - F.col("y0")) / F.col("dy")
    low = lambda f, n: F.greatest(F.lit(0), F.least(F.floor(f), F.col(n) - 2)).cast("int")
    at = at.select("id", *keys, "nx", "ny", fx.alias("fx"), fy.alias("fy")).where("fx between 0 and nx - 1 and fy between 0 and ny - 1")
    at = at.withColumn("ix", low(F.col("fx"), "nx")).withColumn("iy", low(F.col("fy"), "ny"))
    wx, wy = F.col("fx") - F.col("ix"), F.col("fy") - F.col("iy")
    four = F.array(*[F.struct((F.col("iy") + a).alias("yi"), (F.col("ix") + b).alias("xi"), ((wy if a else 1 - wy) * (wx if b else 1 - wx)).alias("w")) for a in (0, 1) for b in (0, 1)])
    some = F.filter(four, lambda c: c["w"] > TINY)
    at = at.select(*keys, "id", some.alias("c"))
    return at.select(*keys, "id", F.size("c").alias("need"), F.explode("c").alias("c")).select(*keys, "id", "need", "c.yi", "c.xi", "c.w")


def interpolated(values: DataFrame, around: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """``(keys, by, id, v)``: each raster ``(keys, by)`` at each target; no row where a corner is missing or NULL.

    ``around`` (``corners``) is shared by all rasters of a key; it is broadcast when its
    counted rows allow, so that the values aren't shuffled before they are summed.
    """
    got = values.where("v is not null").join(sized(around), [*keys, "yi", "xi"])
    got = got.groupBy(*keys, *by, "id").agg(F.count("v").alias("n"), F.max("need").alias("need"), F.sum(F.col("w") * F.col("v")).alias("v"))
    return got.where("n = need").drop("n", "need")


def _named(df: DataFrame, column: str) -> list[str]:
    return [str(r[0]) for r in df.select(column).distinct().orderBy(column).limit(10).collect()]


def require_years(dates: DataFrame, files: DataFrame) -> None:
    """Raise, with at most ten years named, when no tile has a file in a date's calendar year."""
    bare = dates.select(F.year("day").alias("year")).join(files.select(F.year("day").alias("year")), "year", "left_anti")
    if bad := _named(bare, "year"):
        raise ValueError(f"no files of any tile in {', '.join(bad)}")


def tile_indicator(dates: DataFrame, files: DataFrame, values: DataFrame, axes: DataFrame, targets: DataFrame, product: str) -> DataFrame:
    """``(day, id, v)``: for each date and tile the file nearest within the calendar year, regridded, and the largest over tiles.

    ``dates(day)``; ``files(tile, file, day)``; ``values(file, tile, yi, xi, v)``, raw
    numbers, those invalid for the product ignored; ``axes`` by tile on the sinusoidal grid;
    ``targets(id, lon, lat)``.  Of two files as near the first by name is taken.  A file is regridded
    once, however many dates pick it.
    """
    require_years(dates, files)
    files = files.withColumn("year", F.year("day"))
    wanted = files.select("tile", "year").distinct().join(dates.select("day", F.year("day").alias("year")), "year")
    chosen = nearest_date(wanted, files.withColumnRenamed("file", "path"), ["tile", "year"], "day", "path")
    x, y = geo.sinusoidal(F.col("lon"), F.col("lat"))
    around = corners(routed(targets.select("id", x.alias("px"), y.alias("py")), axes, SINUSOIDAL_TILE), ["tile"])
    good = values.withColumn("v", F.when(indices.valid_product(F.lit(product), F.col("v")), F.col("v").cast("double")))
    used = good.join(chosen.select("tile", F.col("path").alias("file")).distinct(), ["tile", "file"], "left_semi")
    by_file = interpolated(used, around, ["tile"], ["file"])
    out = chosen.withColumnRenamed("path", "file").join(by_file, ["tile", "file"])
    return out.groupBy("day", "id").agg(F.max("v").alias("v"))


def nearest_step(dates: DataFrame, steps: DataFrame) -> DataFrame:
    """``(day, step)``: the step of the date's own month that is nearest; of two as near the later.

    Raises, with at most ten months named, when a date's month has no step at all.
    """
    month = lambda c: F.date_format(c, "yyyy-MM")
    if bad := _named(dates.select(month("day").alias("month")).join(steps.select(month("day").alias("month")), "month", "left_anti"), "month"):
        raise ValueError(f"no data for {', '.join(bad)}")
    # as a path the days count down, so the later of two as near comes first
    marks = steps.select("day", month("day").alias("month"), (-F.unix_date("day")).alias("back")).distinct()
    got = nearest_date(dates.select("day", month("day").alias("month")), marks, ["month"], "day", "back")
    return got.select("day", F.date_from_unix_date(-F.col("back")).alias("step"))


def field_on(dates: DataFrame, daily: DataFrame, axes: dict[str, float], targets: DataFrame) -> DataFrame:
    """``(day, id, v)``: ``daily(day, yi, xi, v)`` at its step nearest to each date, then bilinear in space at ``targets(id, lon, lat)``."""
    chosen = nearest_step(dates, daily.select("day").distinct())
    around = corners(placed(targets.select("id", F.col("lon").alias("px"), F.col("lat").alias("py")), axes), [])
    used = daily.withColumnRenamed("day", "step").join(chosen.select("step").distinct(), "step", "left_semi")
    return chosen.join(interpolated(used, around, [], ["step"]), "step").select("day", "id", "v")


def first_cover(dates: DataFrame, files: DataFrame) -> DataFrame:
    """``(day, file)``: the first file by name among those that hold the date.

    ``files(file, first_day, last_day)`` are spread over their days (a month or so each), so the
    dates find them by an equi-join.  Dates that no file covers give no row.
    """
    spread = files.select("file", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return dates.select("day").distinct().join(spread, "day").groupBy("day").agg(F.min("file").alias("file"))


def first_valid(tiles: DataFrame, keys: list[str], order: str, nodata: float | None = None) -> DataFrame:
    """``(keys, v)``: overlapping rasters as one; a pixel takes the first in ``order`` that has a value."""
    v = F.col("v") if nodata is None else F.when(F.col("v") != nodata, F.col("v"))
    held = tiles.withColumn("v", v).where("v is not null")
    return held.groupBy(*keys).agg(F.min_by("v", order).alias("v"))


def utm_pixels(spark: SparkSession, east: float, north: float, zone: int, rows: int, cols: int, res: float) -> DataFrame:
    """``(id, lon, lat)`` of the pixel centres of a north-up grid with that upper left corner, row by row."""
    k = F.col("id")
    y, x = F.floor(k / cols), k % cols
    lon, lat = utm.inverse(F.lit(east) + (x + 0.5) * res, F.lit(north) - (y + 0.5) * res, F.lit(zone))
    return spark.range(rows * cols).select("id", lon.alias("lon"), lat.alias("lat"))


def matched_daily(dates: DataFrame, files: DataFrame, values: DataFrame, axes: dict[str, float], targets: DataFrame) -> DataFrame:
    """``(day, file, id, v)``: for each date the mean of its steps in the first file that covers it, on the targets' grid.

    ``values(file, day, yi, xi, v)`` holds any number of steps a day.
    """
    chosen = first_cover(dates, files)
    mean = values.join(chosen, ["day", "file"], "left_semi").groupBy("file", "day", "yi", "xi").agg(F.avg("v").alias("v"))
    around = corners(placed(targets.select("id", F.col("lon").alias("px"), F.col("lat").alias("py")), axes), [])
    return interpolated(mean, around, [], ["file", "day"]).select("day", "file", "id", "v")


def matched_mosaic(tiles: DataFrame, by: list[str], axes: dict[str, float], targets: DataFrame, nodata: float | None = None) -> DataFrame:
    """``(by, id, v)``: rasters ``tiles(by, tile, yi, xi, v)`` on one sinusoidal pixel grid, merged first, then regridded over their seams."""
    merged = first_valid(tiles, [*by, "yi", "xi"], "tile", nodata)
    x, y = geo.sinusoidal(F.col("lon"), F.col("lat"))
    around = corners(placed(targets.select("id", x.alias("px"), y.alias("py")), axes), [])
    return interpolated(merged, around, [], by)


def sinusoidal_axes(tile: Column, n: Column) -> list[Column]:
    """``x0, dx, nx, y0, dy, ny`` of a tile such as h20v05 with ``n`` x ``n`` pixels; rows go south."""
    h, v = F.substring(tile, 2, 2).cast("int"), F.substring(tile, 5, 2).cast("int")
    step = F.lit(SINUSOIDAL_TILE) / n
    x0, y0 = (h - 18) * SINUSOIDAL_TILE + step / 2, (9 - v) * SINUSOIDAL_TILE - step / 2
    return [x0.alias("x0"), step.alias("dx"), n.cast("int").alias("nx"), y0.alias("y0"), (-step).alias("dy"), n.cast("int").alias("ny")]
