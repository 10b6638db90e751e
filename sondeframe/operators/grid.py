"""Grids as long rows keyed by integer indices: regridding, patches, cells, UTM templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import geo, names, utm
from sondeframe.operators.aggregates import cloud_fraction, valid_fraction


def bilinear(values: DataFrame, targets: DataFrame, lat0: float, dlat: float, n_lat: int, lon0: float, dlon: float, n_lon: int) -> DataFrame:
    """``values(lat_i, lon_i, v)`` at ``targets(id, lat, lon)``; NULL outside the hull or beside a missing corner.

    Corners of weight 0 are not needed, so a target on a node takes the node alone.
    """
    fy, fx = (F.col("lat") - lat0) / dlat, (F.col("lon") - lon0) / dlon
    iy = F.least(F.greatest(F.floor(fy), F.lit(0)), F.lit(max(n_lat - 2, 0))).cast("int")
    ix = F.least(F.greatest(F.floor(fx), F.lit(0)), F.lit(max(n_lon - 2, 0))).cast("int")
    inside = fy.between(0, n_lat - 1) & fx.between(0, n_lon - 1)
    t = targets.select("id", iy.alias("iy"), ix.alias("ix"), (fy - iy).alias("wy"), (fx - ix).alias("wx"), inside.alias("inside"))
    corners = F.explode(F.array(*[F.struct((F.col("iy") + a).alias("lat_i"), (F.col("ix") + b).alias("lon_i"),
        ((F.col("wy") if a else 1 - F.col("wy")) * (F.col("wx") if b else 1 - F.col("wx"))).alias("w")) for a in (0, 1) for b in (0, 1)]))
    c = t.select("id", "inside", corners.alias("c")).select("id", "inside", "c.*").where("w > 0 or not inside")
    got = c.join(values, ["lat_i", "lon_i"], "left")
    whole = F.bool_and("inside") & (F.count("v") == F.count("*"))
    return got.groupBy("id").agg(F.when(whole, F.sum(F.col("w") * F.col("v"))).alias("v"))


def patch_quality(pixels: DataFrame, keys: list[str], min_valid: float = 0.5, patch: int = C.PATCH, height: int | None = None, width: int | None = None) -> DataFrame:
    """``pixels(keys, y, x, red, fmask)`` to patch rows with valid and cloud share; remainders and bad patches are dropped."""
    if height and width:
        pixels = pixels.where((F.col("y") < height // patch * patch) & (F.col("x") < width // patch * patch))
    row, col = F.floor(F.col("y") / patch).cast("int"), F.floor(F.col("x") / patch).cast("int")
    out = pixels.groupBy(*keys, row.alias("row"), col.alias("col")).agg(
        valid_fraction(F.col("red"), C.HLS_FILL).alias("valid_pct"), cloud_fraction(F.col("fmask")).alias("cloud_pct")
    )
    return out.where(F.col("valid_pct") >= min_valid)


def patch_origins(sizes: DataFrame, patch: int = C.PATCH) -> DataFrame:
    """``(id, row, col)`` of the whole patches of each raster ``(id, height, width)``, row by row from the north; remainders are dropped."""
    rows, cols = F.floor(F.col("height") / patch), F.floor(F.col("width") / patch)
    fits = sizes.select("id", rows.alias("_r"), cols.alias("_c")).where("_r > 0 and _c > 0")
    each = fits.select("id", "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_r") * F.col("_c") - 1)).alias("k"))
    return each.select("id", F.floor(F.col("k") / F.col("_c")).cast("int").alias("row"), (F.col("k") % F.col("_c")).cast("int").alias("col"))


def box_cells(boxes: DataFrame, n: int = 16) -> DataFrame:
    """n x n cells of each box ``(id, w, s, e, n)``, row 0 in the south."""
    grid = F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))).alias("k")
    b = boxes.select("id", "w", "s", "e", "n", grid).withColumn("row", F.floor(F.col("k") / n).cast("int")).withColumn("col", (F.col("k") % n).cast("int"))
    dx, dy = (F.col("e") - F.col("w")) / n, (F.col("n") - F.col("s")) / n
    return b.select("id", "row", "col", (F.col("w") + F.col("col") * dx).alias("cw"), (F.col("s") + F.col("row") * dy).alias("cs"),
                    (F.col("w") + (F.col("col") + 1) * dx).alias("ce"), (F.col("s") + (F.col("row") + 1) * dy).alias("cn"))


def whole_cells(boxes: DataFrame, size: int = 1) -> DataFrame:
    """``(id, cell_lon, cell_lat)``: cells that lie wholly in each box ``(id, w, s, e, n)``."""

    def span(low: str, high: str) -> Column:
        a, b = F.ceil(F.col(low) / size) * size, F.floor(F.col(high) / size) * size - size
        return F.explode(F.when(a <= b, F.sequence(a, b, F.lit(size).cast("long"))).otherwise(F.array().cast("array<bigint>")))

    lons = boxes.select("id", "s", "n", span("w", "e").alias("x"))
    return lons.select("id", "x", span("s", "n").alias("y")).select("id", F.col("x").cast("int").alias("cell_lon"), F.col("y").cast("int").alias("cell_lat"))


def squares_in_boxes(boxes: DataFrame, step: float = 0.05, buffer: float = 0.1) -> DataFrame:
    """``(id, tile, w, s, e, n)``: 100 km squares met by a lattice over each buffered box ``(id, w, s, e, n)``, with the box of their own corners.

    The lattice is laid once over each distinct box.
    """
    edges = ["w", "s", "e", "n"]
    axis = lambda a, b: F.sequence(F.lit(0).cast("long"), F.floor((F.col(b) - F.col(a) + 2 * buffer) / step + 1e-6))
    places = boxes.select(*edges).distinct()
    x = places.select(*edges, F.explode(axis("w", "e")).alias("i")).select(*edges, (F.col("w") - buffer + F.col("i") * step).alias("lon"))
    points = x.select(*edges, "lon", F.explode(axis("s", "n")).alias("j")).select(*edges, "lon", (F.col("s") - buffer + F.col("j") * step).alias("lat"))
    square = utm.square_name(F.col("zone"), F.col("east"), F.col("north"), F.col("lat"))
    # Never NULL here; said so, as a join's filter on NULL would evaluate the whole projection as one expression below the points.
    met = utm.projected(points).select(*edges, F.coalesce(square, F.lit("")).alias("tile")).distinct()
    # Estimated sizes leave out the points of a box, so joins are merge joins: no side is collected.
    named = boxes.select("id", *edges).distinct().join(met.hint("merge"), edges).select("id", "tile").distinct()
    return named.join(square_boxes(met.select("tile").distinct()).hint("merge"), "tile").select("id", "tile", *edges)


def square_boxes(tiles: DataFrame) -> DataFrame:
    """``(tile, w, s, e, n)``: the box of the four corners of each northern 100 km square, to four decimals."""
    zone, east, north = utm.square_origin(F.col("tile"))
    corner = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (0.0, 99999.0) for y in (0.0, 99999.0)])).alias("c")
    c = tiles.select("tile", zone.alias("zone"), east.alias("east"), north.alias("north"), corner)
    lon, lat = utm.inverse(F.col("east") + F.col("c.x"), F.col("north") + F.col("c.y"), F.col("zone"))
    edges = (("w", F.min, "lon"), ("s", F.min, "lat"), ("e", F.max, "lon"), ("n", F.max, "lat"))
    return c.select("tile", lon.alias("lon"), lat.alias("lat")).groupBy("tile").agg(*[F.bround(f(v), 4).alias(a) for a, f, v in edges])


def patch_rows(pixels: DataFrame, height: int, width: int, east: float, north: float, zone: int, min_valid: float = 0.5, res: float = 30.0) -> DataFrame:
    """``pixels(mgrs_tile, date, sensor, y, x, red, fmask)`` of one grid to index rows, one a patch.

    ``east, north`` is the grid's upper left corner.  A patch's centre is the pixel centre at
    half its size; shares keep four decimals and coordinates six.  Remainders and patches
    with too few valid pixels are dropped.
    """
    q = patch_quality(pixels, ["mgrs_tile", "date", "sensor"], min_valid, height=height, width=width)
    middle = lambda c: F.col(c) * C.PATCH + C.PATCH // 2 + 0.5
    lon, lat = utm.inverse(east + middle("col") * res, north - middle("row") * res, F.lit(zone))
    q = q.withColumn("center_lon", lon).withColumn("center_lat", lat)
    return q.select(
        names.sample_id(F.col("mgrs_tile"), F.col("date"), F.col("row"), F.col("col")).alias("sample_id"), "mgrs_tile", "date", "row", "col",
        F.bround("center_lon", 6).alias("center_lon"), F.bround("center_lat", 6).alias("center_lat"), geo.patch_region(F.col("center_lon"), F.col("center_lat")).alias("region"),
        F.bround("cloud_pct", 4).alias("cloud_pct"), F.bround("valid_pct", 4).alias("valid_pct"), "sensor",
    )


def harmonise(targets: DataFrame, layers: dict[str, tuple[DataFrame, tuple]]) -> DataFrame:
    """``targets(id, lon, lat)`` with a column for each layer, regridded to them bilinearly.

    A layer is its values ``(lat_i, lon_i, v)`` with the axes (lat0, dlat, n_lat, lon0, dlon, n_lon).
    """
    out = targets
    for name, (values, axes) in layers.items():
        out = out.join(bilinear(values, targets, *axes).withColumnRenamed("v", name), "id")
    return out


def require_aligned(stack: DataFrame, targets: DataFrame) -> None:
    """Raise unless every target has exactly one row in the stack."""
    n = stack.select("id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(targets.select("id", F.lit(0).alias("a"), F.lit(1).alias("b")))
    off = n.groupBy("id").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a <> 1 or b <> 1").count()
    if off:
        raise ValueError(f"layers are not aligned: {off} grid points differ")


def box_pixels(boxes: DataFrame, x: tuple[float, float, int], y: tuple[float, float, int]) -> DataFrame:
    """``boxes`` with ``xi, yi`` for each pixel centre inside ``(w, s, e, n)``, bounds included.

    An axis is (first centre, step, count).  A box that holds no centre on either axis
    gets the one pixel nearest to its own centre (the smaller index of two as near), so
    every box has a pixel.  Index ranges are exploded: no pixel table is joined.
    """

    def span(low: str, high: str, axis: tuple[float, float, int]) -> Column:
        first, step, n = axis
        centre = lambda i: F.lit(first) + i * F.lit(step)
        a = F.greatest(F.lit(0).cast("long"), F.floor((F.col(low) - first) / step) - 1)
        b = F.least(F.lit(n - 1).cast("long"), F.ceil((F.col(high) - first) / step) + 1)
        inside = lambda i: (centre(i) >= F.col(low)) & (centre(i) <= F.col(high))
        return F.when(a <= b, F.filter(F.sequence(a, b), inside)).otherwise(F.array().cast("array<bigint>"))

    def nearest(low: str, high: str, axis: tuple[float, float, int]) -> Column:
        first, step, n = axis
        middle = (F.col(low) + F.col(high)) / 2
        i = F.greatest(F.lit(0).cast("long"), F.least(F.lit(n - 2).cast("long"), F.floor((middle - first) / step)))
        return F.when(F.abs(middle - (first + i * step)) <= F.abs(middle - (first + (i + 1) * step)), i).otherwise(i + 1)

    df = boxes.withColumn("_xs", span("w", "e", x)).withColumn("_ys", span("s", "n", y))
    held = (F.size("_xs") > 0) & (F.size("_ys") > 0)
    df = df.withColumn("xi", F.explode(F.when(held, F.col("_xs")).otherwise(F.array(nearest("w", "e", x)))))
    df = df.withColumn("yi", F.explode(F.when(held, F.col("_ys")).otherwise(F.array(nearest("s", "n", y)))))
    return df.drop("_xs", "_ys")
