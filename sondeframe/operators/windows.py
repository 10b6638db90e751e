"""Rolling, circular, trailing and top-1 windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.operators.joins import sized


def circular_doy(states: DataFrame, keys: list[str], window: int = C.DOY_WINDOW) -> DataFrame:
    """Mean and deviation pooled over a centred window that wraps around the year's 366 days.

    ``states(keys, doy, n, mean, m2)`` as of ``aggregates.doy_moments``.  A year is laid out
    once for each key with its ends repeated, and a window's sums are the difference of two running sums: some
    400 rows a key, however wide the window.  Means count relative to the key's own, so an offset loses no digits.
    """
    half = window // 2
    width = 2 * half + 1
    line = F.explode(F.sequence(F.lit(1 - half), F.lit(366 + half))).alias("_at")
    year = states.groupBy(*keys).agg(F.avg("mean").alias("_c")).select(*keys, "_c", line)
    year = year.withColumn("doy", (F.pmod(F.col("_at") - 1, F.lit(366)) + 1).cast("int"))
    d = F.col("mean") - F.col("_c")
    full = year.join(states.where("n > 0"), [*keys, "doy"], "left")
    parts = {"n": F.coalesce("n", F.lit(0).cast("long")), "_s": F.coalesce(F.col("n") * d, F.lit(0.0)), "_q": F.coalesce(F.col("m2") + F.col("n") * d * d, F.lit(0.0))}
    order = W.partitionBy(*keys).orderBy("_at")
    full = full.select(*keys, "_c", "_at", *[F.sum(v).over(order.rowsBetween(W.unboundedPreceding, 0)).alias(k) for k, v in parts.items()])
    full = full.select(*keys, "_c", (F.col("_at") - half).alias("doy"), *[(F.col(k) - F.coalesce(F.lag(k, width).over(order), F.lit(0))).alias(k) for k in parts])
    s, n = F.col("_s"), F.col("n")
    var = (F.col("_q") - s * s / n) / n
    return full.where("doy between 1 and 366 and n > 0").select(*keys, "doy", "n", (F.col("_c") + s / n).alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"))


def rolling_sum(df: DataFrame, keys: list[str], order: str, value: str, size: int = 3) -> DataFrame:
    """NULL until the frame holds ``size`` values."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(1 - size, 0)
    return df.withColumn("rolled", F.when(F.count(value).over(w) == size, F.sum(value).over(w)))


def water_balance(precip: DataFrame, pet: DataFrame, keys: list[str]) -> DataFrame:
    """Per calendar month, mean and population deviation of the three-month balance."""
    wb = precip.join(pet, [*keys, "ym"]).withColumn("wb", F.col("precip") - F.col("pet"))
    rolled = rolling_sum(wb, keys, "ym", "wb")
    return rolled.groupBy(*keys, (F.col("ym") % 100).alias("month")).agg(F.avg("rolled").alias("wb_mean"), F.stddev_pop("rolled").alias("wb_std"))


def three_months(day: Column) -> Column:
    """The yyyymm keys of a date's month and the two before."""
    months = F.sequence(F.add_months(F.trunc(day, "month"), -2), F.trunc(day, "month"), F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.year(m) * 100 + F.month(m))


def balance_on(days: DataFrame, monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Three-month balance ending in each day's month; NULL if any of the months is missing."""
    wanted = days.select("day", F.explode(three_months(F.col("day"))).alias("ym"))
    got = monthly.select(*keys, "ym", "wb").join(sized(wanted), "ym")
    return got.groupBy(*keys, "day").agg(F.when(F.count("wb") == 3, F.sum("wb")).alias("wb3"))


def trailing_days(end: Column, length: int = C.METEO_DAYS) -> Column:
    if length < 1:
        raise ValueError("a window has at least one day")
    return F.sequence(F.date_sub(end, length - 1), end)


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in a total order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
