"""Class counts of any window of a raster from two-dimensional prefix sums, and the decisions made on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions.sampling import keep_by_class
from sondeframe.operators.grid import box_cells
from sondeframe.operators.joins import sized

CLASSES = (C.NONE, C.DROUGHT, C.HEAT, C.COMPOUND)
COUNTS = [f"n{c}" for c in CLASSES]


def prefix_counts(labels: DataFrame, keys: list[str], n_y: int, n_x: int) -> DataFrame:
    """``(keys, yi, xi, n0..n3)``: how many pixels of each class lie at or below (yi, xi) on both axes.

    ``labels(keys, yi, xi, cls)`` may lack pixels and repeat them; anything but the four
    classes is nodata.  The rasters are filled up, then summed along x and along y: two
    windows, each over one line of a raster.
    """
    one = labels.groupBy(*keys, "yi", "xi").agg(*[F.count_if(F.col("cls") == c).alias(n) for c, n in zip(CLASSES, COUNTS, strict=True)])
    line = one.groupBy(*keys, "yi").agg(F.map_from_entries(F.collect_list(F.struct("xi", F.struct(*COUNTS)))).alias("_m"))  # at most n_x
    rasters = labels.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n_y - 1))).alias("yi"))
    nil = F.struct(*[F.lit(0).cast("long").alias(n) for n in COUNTS])
    rows = rasters.join(line, [*keys, "yi"], "left")
    full = rows.select(*keys, "yi", "_m", F.explode(F.sequence(F.lit(0), F.lit(n_x - 1))).alias("xi"))
    full = full.select(*keys, "yi", "xi", F.coalesce(F.try_element_at("_m", F.col("xi")), nil).alias("c")).select(*keys, "yi", "xi", "c.*")
    across = W.partitionBy(*keys, "yi").orderBy("xi").rowsBetween(W.unboundedPreceding, 0)
    along = W.partitionBy(*keys, "xi").orderBy("yi").rowsBetween(W.unboundedPreceding, 0)
    full = full.select(*keys, "yi", "xi", *[F.sum(n).over(across).alias(n) for n in COUNTS])
    return full.select(*keys, "yi", "xi", *[F.sum(n).over(along).alias(n) for n in COUNTS])


def _range(low: Column, high: Column, axis: tuple[float, float, int]) -> tuple[Column, Column]:
    """First and last index whose centre lies in [low, high], by a guess and one step either way; empty ranges are reversed."""
    first, step, n = axis
    centre = lambda i: F.lit(first) + i * F.lit(step)
    a, b = F.ceil((low - first) / step), F.floor((high - first) / step)
    a = F.when(centre(a - 1) >= low, a - 1).when(centre(a) < low, a + 1).otherwise(a)
    b = F.when(centre(b + 1) <= high, b + 1).when(centre(b) > high, b - 1).otherwise(b)
    return F.greatest(a, F.lit(0).cast("long")), F.least(b, F.lit(n - 1).cast("long"))


def _nearest(middle: Column, axis: tuple[float, float, int]) -> Column:
    """Index of the centre nearest to ``middle``; the smaller of two as near."""
    first, step, n = axis
    i = F.greatest(F.lit(0).cast("long"), F.least(F.lit(n - 2).cast("long"), F.floor((middle - first) / step)))
    return F.when(F.abs(middle - (first + i * step)) <= F.abs(middle - (first + (i + 1) * step)), i).otherwise(i + 1)


def index_windows(boxes: DataFrame, x: tuple[float, float, int], y: tuple[float, float, int]) -> DataFrame:
    """``boxes(cw, cs, ce, cn, ...)`` with ``ya, yb, xa, xb``: the pixels whose centres they hold, bounds included.

    An axis is (first centre, step, count) with a positive step.  A box without a centre on either axis
    takes the one pixel nearest to its middle.
    """
    (xa, xb), (ya, yb) = _range(F.col("cw"), F.col("ce"), x), _range(F.col("cs"), F.col("cn"), y)
    df = boxes.withColumn("_a", xa).withColumn("_b", xb).withColumn("_c", ya).withColumn("_d", yb)
    held = (F.col("_a") <= F.col("_b")) & (F.col("_c") <= F.col("_d"))
    nx, ny = _nearest((F.col("cw") + F.col("ce")) / 2, x), _nearest((F.col("cs") + F.col("cn")) / 2, y)
    pick = lambda c, other: F.when(held, F.col(c)).otherwise(other).cast("int")
    df = df.withColumn("xa", pick("_a", nx)).withColumn("xb", pick("_b", nx)).withColumn("ya", pick("_c", ny)).withColumn("yb", pick("_d", ny))
    return df.drop("_a", "_b", "_c", "_d")


def window_counts(windows: DataFrame, prefixes: DataFrame, keys: list[str]) -> DataFrame:
    """``windows(wid, ya, yb, xa, xb)`` to ``(keys, wid, n0..n3)`` for each raster: four lookups a window, whatever its size.

    The corners of the windows are the same for all rasters, so they are made once and
    broadcast when their counted number allows.
    """
    signs = F.array(*[F.struct(F.lit(s).alias("sign"), F.col(p).alias("yi"), F.col(q).alias("xi")) for s, p, q in ((1, "yb", "xb"), (-1, "_ya", "xb"), (-1, "yb", "_xa"), (1, "_ya", "_xa"))])
    at = windows.withColumn("_ya", F.col("ya") - 1).withColumn("_xa", F.col("xa") - 1)
    at = at.select("wid", F.explode(F.filter(signs, lambda c: (c["yi"] >= 0) & (c["xi"] >= 0))).alias("c")).select("wid", "c.*")
    met = prefixes.join(sized(at), ["yi", "xi"])
    return met.groupBy(*keys, "wid").agg(*[F.sum(F.col("sign") * F.col(n)).alias(n) for n in COUNTS])


def _shaped_counts(tiles: DataFrame, labels: DataFrame, x: tuple[float, float, int], y: tuple[float, float, int], cells: int) -> tuple[DataFrame, DataFrame]:
    """``(id, _boxes)`` and ``(_boxes, row, col, day, n0..n3)``: each id with its distinct boxes (one as a rule), and the counts of each such set.

    Windows that hold the same pixels are looked up once, for all days together.  Estimated
    sizes leave out the cells of a box, so joins are merge joins: no side is collected.
    """
    named = tiles.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("w", "s", "e", "n"))).alias("_boxes"))
    boxes = named.select("_boxes").distinct().select(F.col("_boxes").alias("id"), F.explode("_boxes").alias("b")).select("id", "b.*")
    windows, span = index_windows(box_cells(boxes, cells), x, y).withColumnRenamed("id", "_boxes"), ["ya", "yb", "xa", "xb"]
    spans = windows.select(*span).distinct().withColumn("wid", F.struct(*span))
    counted = window_counts(spans, prefix_counts(labels, ["day"], y[2], x[2]), ["day"])
    counted = counted.groupBy("wid").agg(F.collect_list(F.struct("day", *COUNTS)).alias("_days")).select("wid.*", "_days")  # one a label date
    met = windows.join(counted.hint("merge"), span).select("_boxes", "row", "col", F.inline("_days"))
    summed = met.where(F.size("_boxes") > 1).groupBy("_boxes", "row", "col", "day").agg(*[F.sum(n).alias(n) for n in COUNTS])
    return named, met.where(F.size("_boxes") == 1).unionByName(summed)


def window_class() -> Column:
    """Compound over heat over drought over none by counts; NULL without any."""
    out = F.when(F.col("n0") > 0, 0)
    for c in (1, 2, 3):
        out = F.when(F.col(f"n{c}") > 0, c).otherwise(out)
    return out.cast("int")


def decide_windows(tiles: DataFrame, labels: DataFrame, x: tuple[float, float, int], y: tuple[float, float, int], sample_id, cells: int = 16, probs: dict[int, float] = C.KEEP_PROB, seed: int = C.SEED) -> DataFrame:
    """``(tile, day, row, col, n0..n3, cls, sample_id, kept)`` for every tile ``(id, w, s, e, n)``, label date and cell.

    ``labels(day, yi, xi, cls)``; ``sample_id`` makes the id from the columns tile, day,
    row and col.  Classes come from the windows' counts, the decision to keep from the
    seeded hash of the id; a window of nothing but nodata is dropped.  Counts are made once
    for each distinct box, so tiles only meet rows that are ready, and only ids that a hash
    must decide are spelt.
    """
    named, held = _shaped_counts(tiles, labels, x, y, cells)
    out = named.join(held.hint("merge"), "_boxes").select(F.col("id").alias("tile"), "day", "row", "col", *COUNTS).withColumn("cls", window_class())
    out = out.withColumn("sample_id", sample_id)
    return out.withColumn("kept", F.col("cls").isNotNull() & keep_by_class(F.col("sample_id"), F.col("cls"), probs, seed))
