"""Scans with pushed-down boxes, months and ids.  Canonical input is long-form Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe.functions import geo, names

#: Coordinate aliases, folded to one name.
ALIASES = {"latitude": "lat", "y": "lat", "longitude": "lon", "x": "lon", "valid_time": "time"}


def normalise_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in ALIASES.items() if a in df.columns and b not in df.columns})


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, once, at ingest."""
    fix = lambda f: F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
    return df.select(*[fix(f) for f in df.schema])


def months_spanning(ends: DataFrame, end: str, length: int = 90) -> DataFrame:
    """The (year, month) pairs that any trailing window touches."""
    days = F.explode(F.sequence(F.trunc(F.date_sub(end, length - 1), "month"), F.trunc(end, "month"), F.expr("interval 1 month"))).alias("m")
    return ends.select(days).select(F.year("m").alias("year"), F.month("m").alias("month")).distinct()


def read_months(spark: SparkSession, path: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """A table partitioned by year and month, pruned to these months."""
    df = normalise_names(spark.read.parquet(path))
    want = F.lit(False)
    for y, m in months:
        want = want | ((F.col("year") == y) & (F.col("month") == m))
    return no_nan(df.where(want))


def read_box(spark: SparkSession, path: str, box, years: tuple[int, int] | None = None) -> DataFrame:
    """Rows of a gridded table in a box and, if given, in years; both reach the Parquet scan."""
    df = normalise_names(spark.read.parquet(path))
    df = df.where(geo.in_box(F.col("lon"), F.col("lat"), box))
    return no_nan(df.where(F.year("time").between(*years)) if years else df)


def whole_months(df: DataFrame, day: str, value: str) -> DataFrame:
    """``(year, month, days, valid)``: a month is valid with all its days and any value."""
    g = df.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(F.count_distinct(F.to_date(day)).alias("days"), F.count(value).alias("values"), F.max(F.dayofmonth(F.last_day(day))).alias("want"))
    return g.select("year", "month", "days", ((F.col("days") == F.col("want")) & (F.col("values") > 0)).alias("valid"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, day, sensor, tile, grid_tile)`` of files, without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path")
    name: Column = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.coalesce(names.scene_date(name), names.label_date(name)).alias("day"), names.sensor_of(name).alias("sensor"), names.tile_of(name).alias("tile"), names.grid_tile(name).alias("grid_tile"))


def tiled_inputs(files: DataFrame, year: int, tiles: list[str] | None = None) -> DataFrame:
    """Index files ``tiles_{tile}_{year}.parquet`` without labelled ones."""
    name = F.element_at(F.split("path", "/"), -1)
    df = files.where(name.rlike(rf"^tiles_.*_{year}\.parquet$") & ~name.contains("_labeled"))
    return df.where(names.found(name, r"^tiles_(.+)_\d{4}").isin(tiles)) if tiles else df


def terra_scenes(items: DataFrame, box) -> DataFrame:
    """Terra items whose bounds meet the box."""
    west, south, east, north = box
    return items.where(names.is_terra(F.col("id")) & (F.col("w") <= east) & (F.col("e") >= west) & (F.col("s") <= north) & (F.col("n") >= south))


def parse_box(text: str) -> tuple[float, float, float, float]:
    west, south, east, north = map(float, text.split(","))
    if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
        raise ValueError(f"not a box: {text}")
    return west, south, east, north


def parse_years(text: str) -> list[int]:
    """``2017-2019,2024`` to a list."""
    spans = [list(map(int, p.split("-"))) for p in text.split(",")]
    return [y for s in spans for y in range(s[0], s[-1] + 1)]


def read_table(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """A Parquet, CSV (with a header) or JSON-lines table of a known schema, with the usual names and no NaN."""
    reader = spark.read.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
    elif kind not in ("parquet", "json"):
        raise ValueError(f"no such kind of table: {kind}")
    return no_nan(normalise_names(reader.format(kind).load(path)))
