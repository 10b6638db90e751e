"""Group-by operators.  Aggregates skip NULLs, so missing values need no special case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe import config as C

CLASSES = (C.NONE, C.DROUGHT, C.HEAT, C.COMPOUND)


def spine(df: DataFrame, column: str, values) -> DataFrame:
    """A fixed little table of one column."""
    return df.sparkSession.createDataFrame([(v,) for v in values], [column])


def min_max(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("v_min"), F.max(value).alias("v_max"))


def hourly_to_daily(df: DataFrame, keys: list[str], ts: str, kelvin: str) -> DataFrame:
    celsius = F.col(kelvin) - C.KELVIN
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.max(celsius).alias("tmax"), F.min(celsius).alias("tmin"))


def aggregate_hourly(value: Column, method: str) -> Column:
    rules = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}
    if method not in rules:
        raise ValueError(f"no such method: {method}")
    return rules[method](value)


def daily_channels(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The rule table: t2m and swvl1 mean, e and tp sum, tmax and tmin from t2m."""
    t = F.col("t2m")
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        F.avg(t).alias("t2m"), F.max(t).alias("tmax"), F.min(t).alias("tmin"),
        F.avg("swvl1").alias("swvl1"), F.sum("e").alias("e"), F.sum("tp").alias("tp"),
    )


def moments(value: Column) -> list[Column]:
    """A mergeable state: how many, their mean, and the sum of squared deviations from it."""
    n = F.count(value)
    return [n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2")]


def doy_moments(df: DataFrame, keys: list[str], doy: Column, value: Column) -> DataFrame:
    return df.groupBy(*keys, doy.alias("doy")).agg(*moments(value))


def merge_moments(states: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, n, mean, m2)`` of all values behind some states of each key.

    Means are taken relative to one of their own group, so values far from zero lose no
    digits; that mean and the sums need one shuffle by the keys.
    """
    centre = F.max("mean").over(W.partitionBy(*keys))
    d = F.col("mean") - F.col("_c")
    sums = states.where("n > 0").withColumn("_c", centre).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("_c").alias("_c"), F.sum(F.col("n") * d).alias("_s"), F.sum(F.col("m2") + F.col("n") * d * d).alias("_q"))
    return sums.select(*keys, "n", (F.col("_c") + F.col("_s") / F.col("n")).alias("mean"), F.greatest(F.col("_q") - F.col("_s") * F.col("_s") / F.col("n"), F.lit(0.0)).alias("m2"))


def monthly_sum(df: DataFrame, keys: list[str], value: Column, missing_as_zero: bool = False) -> DataFrame:
    total = F.sum(value)
    return df.groupBy(*keys).agg((F.coalesce(total, F.lit(0.0)) if missing_as_zero else total).alias("total"))


def class_histogram(df: DataFrame, cls: Column) -> DataFrame:
    """Counts of classes 0..3, zero-filled; anything else is ignored."""
    counts = df.select(cls.alias("cls")).groupBy("cls").agg(F.count("*").alias("n"))
    return spine(df, "cls", CLASSES).select(F.col("cls").cast("int")).join(F.broadcast(counts), "cls", "left").select("cls", F.coalesce("n", F.lit(0)).alias("n"))


def valid_fraction(value: Column, fill: float) -> Column:
    """Share of values that exist and aren't the fill; 0 for nothing."""
    return F.coalesce(F.avg(F.coalesce(value != fill, F.lit(False)).cast("double")), F.lit(0.0))


def cloud_fraction(fmask: Column) -> Column:
    seen = fmask != C.FMASK_FILL
    cloudy = seen & (fmask.bitwiseAND(F.lit(C.CLOUD_BITS)) != 0)
    return F.coalesce(F.try_divide(F.count_if(cloudy), F.count_if(seen)), F.lit(1.0))


def class_weights(counts: DataFrame, scheme: str = "median_freq") -> DataFrame:
    """``(cls, n)`` to ``(cls, n, weight)``; absent classes weigh 0."""
    n = F.col("n")
    total = counts.agg(F.sum("n").alias("total"), F.count_if(n > 0).alias("present"))
    if scheme == "inverse":
        weight = F.when(n > 0, F.col("total") / (F.col("present") * n))
    elif scheme == "median_freq":
        middle = counts.where(n > 0).agg(F.percentile("n", 0.5).alias("middle"))
        total = total.join(F.broadcast(middle))  # one row each
        weight = F.when(n > 0, F.col("middle") / n)
    else:
        raise ValueError(f"no such scheme: {scheme}")
    return counts.join(F.broadcast(total)).select("cls", "n", F.coalesce(weight, F.lit(0.0)).alias("weight"))


def channel_stats(long: DataFrame, channels=C.CHANNELS) -> DataFrame:
    """Mean and population deviation a channel; nothing gives (0, 1), a zero deviation 1."""
    stats = long.groupBy("channel").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    out = spine(long, "channel", channels).join(F.broadcast(stats), "channel", "left")
    std = F.when(F.col("std") > 0, F.col("std")).otherwise(1.0)
    return out.select("channel", F.coalesce("mean", F.lit(0.0)).alias("mean"), std.alias("std"))


def normalise(long: DataFrame, stats: DataFrame) -> DataFrame:
    return long.join(F.broadcast(stats), "channel").withColumn("z", (F.col("value") - F.col("mean")) / F.when(F.col("std") > 0, F.col("std")).otherwise(1.0))


def patch_class(cls: Column) -> Column:
    """Compound over heat over drought over none; NULL when all is nodata."""
    return F.max(F.when(cls != C.NODATA, cls))


def mosaic_max(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(value))


def prevalence_gate(counts: DataFrame, low: float = C.GATE[0], high: float = C.GATE[1]) -> DataFrame:
    """``(cls, n)`` pooled: fractions, the compound share and the verdict."""
    pooled = counts.groupBy("cls").agg(F.sum("n").alias("n"))
    total = pooled.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("cls") == C.COMPOUND, F.col("n")).otherwise(0)).alias("hits"))
    share = F.coalesce(F.try_divide(F.col("hits"), F.col("total")), F.lit(0.0))
    verdict = F.when(share < low, "too strict").when(share > high, "too lax").otherwise("pass")
    own = F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0))
    return pooled.join(F.broadcast(total)).select("cls", "n", own.alias("fraction"), share.alias("compound_fraction"), verdict.alias("verdict"))


def independent_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(dimension, value, n)``: a count for each value of each column, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")
    return df.select(pairs).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def daily_mean(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.avg(value).alias(value))


def tile_summary(index: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, mean cloud and mean valid share by key."""
    return index.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("cloud_pct").alias("cloud_pct"), F.avg("valid_pct").alias("valid_pct"))


def pooled_weights(labels: DataFrame, cls: Column, scheme: str = "median_freq") -> DataFrame:
    """Class counts over all tiles, their weights and the compound share of the pool."""
    out = class_weights(class_histogram(labels, cls), scheme)
    total = out.agg(F.sum("n").alias("_t"), F.sum(F.when(F.col("cls") == C.COMPOUND, F.col("n")).otherwise(0)).alias("_c"))
    return out.join(F.broadcast(total)).select("cls", "n", "weight", F.coalesce(F.try_divide("_c", "_t"), F.lit(0.0)).alias("compound_fraction"))  # one row


def land_coverage(labels: DataFrame, keys: list[str], cls: Column) -> DataFrame:
    """``(keys, pixels, labelled, coverage)``: the share of pixels that hold a class."""
    there = F.coalesce(cls.isin(*CLASSES), F.lit(False))
    return labels.groupBy(*keys).agg(F.count("*").alias("pixels"), F.count_if(there).alias("labelled"), F.avg(there.cast("double")).alias("coverage"))
