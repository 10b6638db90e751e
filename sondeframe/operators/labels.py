"""The label build: grids and climatologies to a class for each cell and composite date, as one plan over all dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe.functions import indices
from sondeframe.operators.windows import balance_on


def nearest_in_year(targets: DataFrame, series: DataFrame, out: str) -> DataFrame:
    """``targets(cell, day)`` with the value of ``series(cell, day, v)`` nearest in days within the calendar year; ties to the earlier day."""
    t = targets.select("cell", "day", F.year("day").alias("_y"))
    s = series.select("cell", F.year("day").alias("_y"), F.col("day").alias("_d"), "v")
    gap = F.struct(F.abs(F.datediff("day", "_d")), F.col("_d"))
    return t.join(s, ["cell", "_y"]).groupBy("cell", "day").agg(F.min_by("v", gap).alias(out))


def build_labels(
    dates: DataFrame, balance: DataFrame, balance_stats: DataFrame, tmax: DataFrame, tmax_stats: DataFrame,
    ndvi: DataFrame, lst: DataFrame, limits: DataFrame,
) -> DataFrame:
    """``(cell, day, spei3, tmax_z, vhi, cls)``.

    Inputs: ``dates(day)``; ``balance(cell, ym, wb)``; ``balance_stats(cell, month,
    wb_mean, wb_std)``; ``tmax(cell, day, tmax)``; ``tmax_stats(cell, doy, mean, std)``;
    ``ndvi`` and ``lst (cell, day, v)``; ``limits(cell, ndvi_lo, ndvi_hi, lst_lo,
    lst_hi)``.  Dates whose three months are incomplete give no row; a cell lacking
    any indicator is 255.
    """
    grid = balance_on(dates, balance, ["cell"]).where("wb3 is not null")
    df = grid.withColumn("month", F.month("day")).withColumn("doy", F.dayofyear("day")).join(balance_stats, ["cell", "month"], "left")
    df = df.join(tmax, ["cell", "day"], "left").join(tmax_stats.select("cell", "doy", "mean", "std"), ["cell", "doy"], "left")
    keys = grid.select("cell", "day")
    df = df.join(nearest_in_year(keys, ndvi, "ndvi"), ["cell", "day"], "left").join(nearest_in_year(keys, lst, "lst"), ["cell", "day"], "left")
    c = F.col
    df = df.join(limits, "cell", "left")
    cols = indices.label_columns(c("ndvi"), c("ndvi_lo"), c("ndvi_hi"), c("lst"), c("lst_lo"), c("lst_hi"), c("wb3"), c("wb_mean"), c("wb_std"), c("tmax"), c("mean"), c("std"))
    out = df.select("cell", "day", *[v.alias(k) for k, v in cols.items()])
    return out.withColumn("cls", indices.masked_class(c("spei3"), c("tmax_z"), c("vhi")))
