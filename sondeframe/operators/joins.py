"""As-of, nearest, range, neighbour and distance joins, each as an equi-join on a derived key."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe import config as C


#: Rows up to which a table whose size is not fixed is broadcast.
BROADCAST_ROWS = 500_000
#: Days in a bucket of the as-of joins.
BUCKET_DAYS = 64
#: Ids of one place that share a row in a distance join.
STACK = 256


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted rows are within ``most``; beyond, Spark shuffles both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _bucket(at: Column, days: int) -> Column:
    return F.floor(F.unix_date(at.cast("date")) / days)


def _with_carried(marks: DataFrame, wanted: DataFrame, keys: list[str], days: int) -> DataFrame:
    """``(keys, _bucket, _at, _mark, _side, _before, _after)``: marks (side 0) and wanted times (side 1) by bucket of days.

    ``_before`` is the last mark of all earlier buckets and ``_after`` the first of all
    later ones, carried over by a window with one row a bucket.  So no task holds
    more of a key than one bucket and one row for each other bucket.
    """
    both = marks.select(*keys, "_at", "_mark", F.lit(0).alias("_side")).unionByName(wanted.select(*keys, "_at", F.lit(None).cast(marks.schema["_mark"].dataType).alias("_mark"), F.lit(1).alias("_side")))
    both = both.withColumn("_bucket", _bucket(F.col("_at"), days))
    ends = both.groupBy(*keys, "_bucket").agg(F.max_by("_mark", F.when(F.col("_side") == 0, F.struct("_at", "_mark"))).alias("_last"), F.min_by("_mark", F.when(F.col("_side") == 0, F.struct("_at", "_mark"))).alias("_first"))
    order = W.partitionBy(*keys).orderBy("_bucket")
    ends = ends.withColumn("_before", F.last("_last", True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    ends = ends.withColumn("_after", F.first("_first", True).over(order.rowsBetween(1, W.unboundedFollowing)))
    names = [*keys, "_bucket"]
    ends = ends.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(names)], "_before", "_after")
    same = [both[k].eqNullSafe(ends[f"_e{i}"]) for i, k in enumerate(names)]
    return both.join(ends, same).select(*names, "_at", "_mark", "_side", "_before", "_after")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], on: str, out: str, days: int = BUCKET_DAYS) -> DataFrame:
    """The latest right value at or before the left one, else the earliest of the key.

    ``right`` holds the keys and ``on`` (dates or timestamps); the match is NULL for a
    key without any.  Only distinct (key, time) take part, in buckets of ``days``; rows get
    their match by an equi-join.  No pair is formed, and a key of any size is split.
    """
    marks = right.where(F.col(on).isNotNull()).select(*keys, F.col(on).alias("_at"), F.col(on).alias("_mark")).distinct()
    wanted = left.select(*keys, F.col(on).alias("_at")).distinct()
    both = _with_carried(marks, wanted, keys, days)
    upto = W.partitionBy(*keys, "_bucket").orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    onward = W.partitionBy(*keys, "_bucket").orderBy(F.desc("_at"), F.desc("_side")).rowsBetween(W.unboundedPreceding, 0)
    first = F.coalesce(F.last("_mark", True).over(onward), F.col("_after"))
    both = both.withColumn(out, F.coalesce(F.last("_mark", True).over(upto), F.col("_before"), first)).where("_side = 1")
    found = both.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_at").alias("_t"), out)
    same = [left[k].eqNullSafe(found[f"_k{i}"]) for i, k in enumerate(keys)] + [left[on].eqNullSafe(found["_t"])]
    return left.join(found, same, "left").select(*[left[c] for c in left.columns], out)


def as_of_small(left: DataFrame, dates: DataFrame, on: str, out: str) -> DataFrame:
    """As ``as_of`` without keys, for a date list of bounded size (dates of some years): one array, searched in each row."""
    held = dates.agg(F.sort_array(F.collect_set(on)).alias("_d"))  # one row
    before = F.filter("_d", lambda d: d <= F.col(on))
    match = F.coalesce(F.array_max(before), F.array_min("_d"))
    return left.join(F.broadcast(held)).withColumn(out, match).drop("_d")


def nearest_date(left: DataFrame, right: DataFrame, keys: list[str], day: str, path: str, days: int = BUCKET_DAYS) -> DataFrame:
    """The right row nearest in days in either direction; ties go to the smaller path.

    Two passes over buckets of ``days``, back and forth: linear in both sides, no pair is
    formed, and a key of any size is split.  A key without right rows gives no rows.
    """
    marks = right.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.min(path).alias("_path"))
    marks = marks.select(*keys, F.col(day).alias("_at"), F.struct(F.col(day).alias("d"), F.col("_path").alias("p")).alias("_mark"))
    both = _with_carried(marks, left.select(*keys, F.col(day).alias("_at")).distinct(), keys, days)
    of = W.partitionBy(*keys, "_bucket")
    back = of.orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    on = of.orderBy(F.desc("_at"), "_side").rowsBetween(W.unboundedPreceding, 0)
    both = both.withColumn("_a", F.coalesce(F.last("_mark", True).over(back), F.col("_before"))).withColumn("_b", F.coalesce(F.last("_mark", True).over(on), F.col("_after"))).where("_side = 1")
    gap = lambda m: F.when(F.col(m).isNotNull(), F.struct(F.abs(F.datediff("_at", F.col(m)["d"])).alias("n"), F.col(m)["p"].alias("p")))
    near = F.least(gap("_a"), gap("_b"))
    return both.where("_a is not null or _b is not null").select(*keys, F.col("_at").alias(day), near["p"].alias(path))


def grid_index(value: Column, first: float, step: float, n: int) -> Column:
    """Nearest index on a regular axis (the even one of two as near), clamped to it."""
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.bround((value - first) / step).cast("int")))


def boxes_to_points(boxes: DataFrame, points: DataFrame, box_id: str, cell: float = 1.0) -> DataFrame:
    """Points inside inclusive boxes ``(w, s, e, n)``: boxes are spread over the cells they meet, then an equi-join."""
    spread = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))
    b = boxes.withColumn("_x", F.explode(spread("w", "e"))).withColumn("_y", F.explode(spread("s", "n")))
    p = points.withColumn("_x", F.floor(F.col("lon") / cell)).withColumn("_y", F.floor(F.col("lat") / cell))
    inside = F.col("lon").between(F.col("w"), F.col("e")) & F.col("lat").between(F.col("s"), F.col("n"))
    return b.join(p, ["_x", "_y"]).where(inside).drop("_x", "_y")


def _stacked(points: DataFrame) -> DataFrame:
    """``(lon, lat, ids)`` of ``(id, lon, lat)``: equal places share a row, up to ``STACK`` ids in each; ids are kept as often as they occur."""
    placed = points.where("lon is not null and lat is not null").select("id", "lon", "lat")
    chunk = F.floor((F.row_number().over(W.partitionBy("lon", "lat").orderBy("id")) - 1) / STACK)
    # Ids that are NULL are counted, as collect_list leaves them out.
    nulls = F.array_repeat(F.lit(None).cast(placed.schema["id"].dataType), F.count_if(F.col("id").isNull()).cast("int"))
    return placed.withColumn("_c", chunk).groupBy("lon", "lat", "_c").agg(F.concat(nulls, F.collect_list("id")).alias("ids")).drop("_c")


def _close(near: DataFrame, far: DataFrame, km: float) -> DataFrame:
    """Rows of ``near(lon, lat, ...)`` and ``far(lon, lat, ...)`` closer than ``km``, with the distance as ``km``; other columns must differ by name.

    Points are dealt to cubes with edges of ``km`` around the globe's centre.  A chord is
    no longer than its arc, so partners lie in the same or a neighbouring cube, at the
    poles and across 180 degrees too.  Near points look into those of the 27 that the
    sphere crosses and a ball of ``km`` reaches.  Chords decide all but a thin band about
    ``km``, where the distance does.  Sides meet by a merge join: no side is collected.
    """
    axes, unit = "xyz", C.EARTH_KM / km
    chord = 2 * math.sin(min(km / C.EARTH_KM, math.pi) / 2)
    surely, most = ((chord * (1 - 1e-9) - 1e-13) ** 2, (chord * (1 + 1e-9) + 1e-13) ** 2) if km < C.EARTH_KM else (-1.0, 5.0)

    def placed(df: DataFrame, side: int) -> DataFrame:
        lon, lat = F.radians("lon"), F.radians("lat")
        at = (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))
        own = [F.col("lon").alias(f"_lon{side}"), F.col("lat").alias(f"_lat{side}"), F.cos(lat).alias(f"_c{side}"), *[v.alias(f"_{k}{side}") for k, v in zip(axes, at, strict=True)]]
        return df.select(*own, *[c for c in df.columns if c not in ("lon", "lat")]).withColumns({f"_{k}": F.floor(F.col(f"_{k}{side}") * unit) for k in axes})

    total = lambda f: reduce(lambda a, b: a + b, [f(k, i) * f(k, i) for i, k in enumerate(axes)])
    step = lambda i: F.floor(F.col("_d") / 3**i) % 3 - 1
    part = lambda k: F.col(f"_{k}1") * unit - F.col(f"_{k}")
    gap = lambda k, i: F.when(step(i) < 0, part(k)).when(step(i) > 0, 1 - part(k)).otherwise(0.0)
    a = placed(near, 1).withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(26)))).where(total(gap) <= 1.001)
    a = a.withColumns({f"_{k}": F.col(f"_{k}") + step(i) for i, k in enumerate(axes)}).drop("_d")
    inner = total(lambda k, i: F.greatest(F.col(f"_{k}"), -1 - F.col(f"_{k}"), F.lit(0)).cast("double"))
    outer = total(lambda k, i: F.greatest(F.abs(f"_{k}"), F.abs(F.col(f"_{k}") + 1)).cast("double"))
    a = a.where((inner <= unit**2 * (1 + 1e-9)) & (outer >= unit**2 * (1 - 1e-9)))
    b = placed(far, 2)

    apart = total(lambda k, i: F.col(f"_{k}1") - F.col(f"_{k}2"))
    half = lambda c: F.pow(F.sin(F.radians(F.col(f"_{c}2") - F.col(f"_{c}1")) / 2), 2)
    d = 2 * C.EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(half("lat") + F.col("_c1") * F.col("_c2") * half("lon"))))
    met = a.join(b.hint("merge"), [f"_{k}" for k in axes]).where((apart <= most) & ((apart <= surely) | (d < km)))
    return met.select(*[c for c in (*near.columns, *far.columns) if c not in ("lon", "lat")], d.alias("km"))


def pairs_within(near: DataFrame, far: DataFrame, km: float = C.BUFFER_KM) -> DataFrame:
    """``(near_id, far_id, km)`` closer than ``km``, from tables ``(id, lon, lat)``, anywhere on the globe.

    Places are compared once each, and their ids are put out for every pair of places.
    """
    a, b = _stacked(near).withColumnRenamed("ids", "_near"), _stacked(far).withColumnRenamed("ids", "_far")
    met = _close(a, b, km).select(F.explode("_near").alias("near_id"), "_far", "km")
    return met.select("near_id", F.explode("_far").alias("far_id"), "km")


def count_within(near: DataFrame, far: DataFrame, km: float = C.BUFFER_KM) -> DataFrame:
    """One row ``n``: how many pairs ``pairs_within`` would give, from counts by place; no pair of ids is formed."""
    counted = lambda df, n: df.where("lon is not null and lat is not null").groupBy("lon", "lat").agg(F.count("*").alias(n))
    met = _close(counted(near, "_m"), counted(far, "_n"), km)
    return met.agg(F.coalesce(F.sum(F.col("_m") * F.col("_n")), F.lit(0).cast("long")).alias("n"))


def months_must_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Months that only one of two monthly series has; callers raise when there are any."""
    a, b = left.select("ym").distinct(), right.select("ym").distinct()
    return a.exceptAll(b).unionByName(b.exceptAll(a))


def require_same_months(left: DataFrame, right: DataFrame) -> None:
    """Raise, with at most ten of them named, when one of two monthly series has months that the other lacks."""
    odd = months_must_match(left, right).orderBy("ym").limit(10).collect()
    if odd:
        raise ValueError(f"months without a partner: {[r['ym'] for r in odd]}")


def work_left(tiles: DataFrame, years: DataFrame, done: DataFrame, labelled: DataFrame) -> DataFrame:
    """Tile-year pairs to do: each tile with each labelled year of the list, less what is done.

    The years become one array (some tens), so tiles are exploded and never joined with them.
    """
    wanted = years.join(labelled, "year", "left_semi").agg(F.sort_array(F.collect_set("year")).alias("_years"))  # one row
    return tiles.join(F.broadcast(wanted)).select(*tiles.columns, F.explode("_years").alias("year")).join(done, ["tile", "year"], "left_anti")
