"""Scene catalogs: pushed-down search, one scene a window or date, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import geo, names
from sondeframe.operators.windows import first_of

BANDS = {"S30": C.BANDS_S30, "L30": C.BANDS_L30}


def search(items: DataFrame, tile: str, start: str, end: str, cloud_max: float = 50.0) -> DataFrame:
    """Items ``(id, day, cloud, ...)`` of exactly this tile, in the dates, below the cloud limit, by (day, id)."""
    near = (F.col("day") >= F.lit(start).cast("date")) & (F.col("day") <= F.lit(end).cast("date")) & (F.col("cloud") < cloud_max)
    return items.where(near).where(names.part(F.col("id"), 2) == tile).orderBy("day", "id")


def search_all(collections: list[DataFrame], tile: str, start: str, end: str, box=None, cloud_max: float = 50.0, most: int | None = None) -> DataFrame:
    """``search`` over several collections at once, in a box ``(w, s, e, n)`` of the items' points, at most ``most`` items."""
    items = reduce(DataFrame.unionByName, collections)
    if box:
        items = items.where(geo.in_box(F.col("lon"), F.col("lat"), box))
    found = search(items, tile, start, end, cloud_max)
    return found.limit(most) if most is not None else found


def window_of(day: Column, starts: Column, days: int = 16) -> Column:
    """The first window ``[w, w + days)`` that holds the day, of an array of starts."""
    return F.array_min(F.filter(starts, lambda w: (w <= day) & (day < F.date_add(w, days))))


def one_per_window(items: DataFrame, starts: DataFrame, hrefs: Column, days: int = 16) -> DataFrame:
    """Clearest item a window (missing cloud 100); a winner without all bands drops its window."""
    held = starts.agg(F.sort_array(F.collect_set("start")).alias("_starts"))  # one row: the dates of some years
    df = items.join(F.broadcast(held)).withColumn("window", window_of(F.col("day"), F.col("_starts"), days)).drop("_starts")
    best = first_of(df.where("window is not null"), ["window"], [F.coalesce("cloud", F.lit(100.0)), F.col("day"), F.col("id")])
    return best.withColumn("hrefs", hrefs).where("hrefs is not null")


def first_per_date(items: DataFrame, hrefs: Column) -> DataFrame:
    """The first streamable item of each date in (date, id) order."""
    return first_of(items.withColumn("hrefs", hrefs).where("hrefs is not null"), ["day"], [F.col("id")])


def disk_scenes(paths: DataFrame) -> DataFrame:
    """``(day, sensor, path)`` from red-band paths; of several on a date the last in name order stays."""
    df = paths.where(F.col("path").contains(".B04.")).withColumn("day", names.scene_date(F.col("path")))
    df = df.withColumn("sensor", names.found(F.col("path"), r"HLS\.(S30|L30)\.")).where("day is not null")
    return df.groupBy("day").agg(F.max_by("sensor", "path").alias("sensor"), F.max("path").alias("path"))


def resolve_scenes(scenes: DataFrame, source: str, hrefs: Column | None = None, starts: DataFrame | None = None) -> DataFrame:
    """``(day, sensor, item)`` by a strategy over one frame of scenes.

    ``disk`` takes ``scenes(path)`` as they lie there; ``catalog`` takes items ``(id, day,
    cloud)``: the clearest of each window when ``starts`` are given, else the first of each date, only those with all ``hrefs``.
    """
    if source == "disk":
        return disk_scenes(scenes).select("day", "sensor", F.col("path").alias("item"))
    if source != "catalog" or hrefs is None:
        raise ValueError(f"no such source of scenes, or no links: {source}")
    found = first_per_date(scenes, hrefs) if starts is None else one_per_window(scenes, starts, hrefs)
    return found.select("day", names.sensor_of(F.col("id")).alias("sensor"), F.col("id").alias("item"))


def find_reference(paths: DataFrame, want: str | None = None) -> DataFrame:
    """The first file of a date, else the first in name order."""
    df = paths.withColumn("day", names.scene_date(F.col("path")))
    return (df.where(F.col("day") == F.lit(want).cast("date")) if want else df).orderBy("path").limit(1)
