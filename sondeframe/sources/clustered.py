"""Tables of points laid out along a space-filling curve, so that a box reads few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16


def _spread(v: Column) -> Column:
    """The 16 bits of a long, each followed by a zero bit."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def curve(lon: Column, lat: Column) -> Column:
    """Place on the curve: the bits of longitude and latitude in turn, some 0.005 degrees fine; NULL without a position."""
    cells = 1 << BITS
    x = F.least(F.floor((lon + 180) / 360 * cells), F.lit(cells - 1)).cast("long")
    y = F.least(F.floor((lat + 90) / 180 * cells), F.lit(cells - 1)).cast("long")
    return F.when(lon.isNotNull() & lat.isNotNull(), _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)))


def write_clustered(points: DataFrame, path: str, files: int | None = None, group_bytes: int = 8 << 20, lon: str = "lon", lat: str = "lat") -> None:
    """Write points range-partitioned and sorted along the curve, in row groups of about ``group_bytes``.

    Neighbours share files and row groups, whose bounds on both columns let ``readers.read_box``
    skip the others.  The range partitioning samples the rows, so dense areas get more files.
    """
    place = curve(F.col(lon), F.col(lat))
    df = points.withColumn("_place", place)
    df = df.repartitionByRange(files, "_place") if files else df.repartitionByRange("_place")
    df = df.sortWithinPartitions("_place", lon, lat).drop("_place")
    df.write.option("parquet.block.size", group_bytes).option("parquet.page.size", min(group_bytes, 1 << 20)).mode("overwrite").parquet(path)
