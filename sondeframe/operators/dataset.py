"""Labelled index: selection, series, assembly and acceptance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions.sampling import keep_by_class
from sondeframe.operators.aggregates import patch_class
from sondeframe.operators.joins import count_within, pairs_within
from sondeframe.operators.windows import trailing_days


def select_patches(labels: DataFrame, keys: list[str], sample_id) -> DataFrame:
    """``labels(keys, cls)`` to a patch class and the seeded decision to keep."""
    out = labels.groupBy(*keys).agg(patch_class(F.col("cls")).alias("cls")).withColumn("sample_id", sample_id)
    return out.withColumn("kept", F.col("cls").isNotNull() & keep_by_class(F.col("sample_id"), F.col("cls")))


def selection_report(patches: DataFrame, keys: list[str], years: int = 8) -> DataFrame:
    """Counts by key and overall (rollup), with the size estimate."""
    of = lambda k: F.count_if((F.col("cls") == k) & F.col("kept")).alias(f"kept_{k}")
    r = patches.rollup(*keys).agg(F.count("*").alias("n_patches"), F.count_if(F.col("cls").isNull()).alias("n_nodata"), *[of(k) for k in range(4)], F.count_if("kept").alias("n_kept"))
    gb = F.col("n_kept") * years * C.KB_PER_SAMPLE / 1e6
    return r.withColumn("compound_fraction", F.coalesce(F.try_divide(F.col("kept_3"), F.col("n_kept")), F.lit(0.0))).withColumn("gb", gb)


def keep_list(patches: DataFrame, keys: list[str]) -> DataFrame:
    """tile, date -> sorted [row, col, class] of the patches of one raster (bounded by its grid)."""
    return patches.where("kept").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("row", "col", "cls"))).alias("patches"))


def meteo_series(samples: DataFrame, daily: DataFrame, keys: list[str], length: int = C.METEO_DAYS) -> DataFrame:
    """Long ``(sample_id, day, channels...)`` on a whole spine of days; absent days stay with NULLs."""
    line = samples.select("sample_id", *keys, F.explode(trailing_days(F.col("end"), length)).alias("day"))
    return line.join(daily, [*keys, "day"], "left")


def coverage(series: DataFrame, channels: list[str], length: int = C.METEO_DAYS) -> DataFrame:
    there = reduce(lambda a, b: a + b, [F.count(c) for c in channels])
    return series.groupBy("sample_id").agg((there / (length * len(channels))).alias("coverage"))


def consolidate(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("nothing to consolidate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def members(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of member splits, and counts of the others by label."""
    inside = F.coalesce(F.col("split").isin(*C.MEMBERS), F.lit(False))
    return index.where(inside), index.where(~inside).groupBy("split").agg(F.count("*").alias("n"))


def inside(index: DataFrame, keep_outside: bool = False) -> DataFrame:
    """Rows within the area of interest, unless those outside are wanted too; an unknown split is outside."""
    return index if keep_outside else index.where(F.coalesce(F.col("split") != "none", F.lit(False)))


def violations(index: DataFrame) -> DataFrame:
    """Rows that break a bound or an enumeration: ``(sample_id, problems)``."""
    rules = {
        "center_lon": "center_lon between -180 and 180", "center_lat": "center_lat between -90 and 90", "cloud_pct": "cloud_pct between 0 and 1",
        "valid_pct": "valid_pct between 0 and 1", "region": "region in ('em_shelf', 'delta', 'n_coast', 'ood_nw_africa')",
        "split": "split in ('train', 'val', 'test', 'ood', 'buffer', 'none')",
    }
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(r), F.lit(False)), k) for k, r in rules.items()]))
    return index.select("sample_id", bad.alias("problems")).where(F.size("problems") > 0)


def _sides(index: DataFrame, near: str, far: str) -> tuple[DataFrame, DataFrame]:
    points = index.select(F.col("sample_id").alias("id"), F.col("center_lon").alias("lon"), F.col("center_lat").alias("lat"), "split")
    return points.where(F.col("split") == near), points.where(F.col("split") == far)


def spatial_leaks(index: DataFrame, near: str = "test", far: str = "train", km: float = C.BUFFER_KM) -> DataFrame:
    return pairs_within(*_sides(index, near, far), km)


def count_spatial_leaks(index: DataFrame, near: str = "test", far: str = "train", km: float = C.BUFFER_KM) -> DataFrame:
    """One row ``n``: the number of rows of ``spatial_leaks``, from counts by place."""
    return count_within(*_sides(index, near, far), km)


def dates_in_both(index: DataFrame, near: str = "test", far: str = "train") -> DataFrame:
    """Dates that samples of two splits share."""
    df = index.where(F.col("split").isin(near, far)).groupBy("day").agg(F.count_distinct("split").alias("parts"), F.count("*").alias("n"))
    return df.where("parts > 1").select("day", "n")


def dense_series(samples: DataFrame, sources: list[DataFrame], keys: list[str], channels: list[str], length: int = C.METEO_DAYS) -> DataFrame:
    """``(sample_id, days, meteo)``: one array of ``length`` rows of channels, the oldest day first, absent values NULL.

    Each daily source joins the spine of days by itself, so a source without a day
    leaves its own channels NULL only.
    """
    line = samples.select("sample_id", *keys, F.explode(trailing_days(F.col("end"), length)).alias("day"))
    for source in sources:
        line = line.join(source, [*keys, "day"], "left")
    rows = F.array_sort(F.collect_list(F.struct("day", F.array(*[F.col(c).cast("float") for c in channels]).alias("v"))))
    packed = line.groupBy("sample_id").agg(rows.alias("_r"))  # `length` rows for each sample
    return packed.select("sample_id", F.col("_r.day").alias("days"), F.col("_r.v").alias("meteo"))


def in_store_order(index: DataFrame, order: DataFrame) -> DataFrame:
    """Index rows by the places of an array store: ``order(store, position, sample_id)`` joined with the index, sorted by place.

    Raises, with at most ten of them named, when the store holds samples that the index lacks.
    Each store's rows come together in one partition, so arrays written from them follow its order.
    """
    lost = order.join(index.select("sample_id"), "sample_id", "left_anti").select("sample_id").orderBy("sample_id").limit(10).collect()
    if lost:
        raise ValueError(f"not in the index: {', '.join(str(r['sample_id']) for r in lost)}")
    return order.join(index, "sample_id").repartition("store").sortWithinPartitions("store", "position")


def acceptance(index: DataFrame) -> DataFrame:
    """``(check, found, passed)`` for the schema, the distance of test and train, and their dates."""
    count = lambda df: df.agg(F.count("*").alias("n"))
    kinds = {"schema": count(violations(index)), "spatial": count_spatial_leaks(index), "temporal": count(dates_in_both(index))}
    parts = [df.select(F.lit(k).alias("check"), F.col("n").alias("found"), (F.col("n") == 0).alias("passed")) for k, df in kinds.items()]
    return reduce(DataFrame.unionByName, parts)


def require_accepted(index: DataFrame) -> None:
    """Raise when any check of ``acceptance`` finds something."""
    bad = [r for r in acceptance(index).collect() if not r["passed"]]  # three rows at most
    if bad:
        raise ValueError(", ".join(f"{r['check']}: {r['found']}" for r in bad))


def new_rows(found: DataFrame, known: DataFrame) -> DataFrame:
    """What isn't yet in the index, once each."""
    return found.dropDuplicates(["sample_id"]).join(known.select("sample_id"), "sample_id", "left_anti")
