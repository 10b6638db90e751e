"""Registered queries over rasters: tiled composites, daily fields, scene grids, windows and label patches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import names, utm
from sondeframe.operators import catalog, joins, patches, prefix, regrid
from sondeframe.plans.derived import derived, monthly, sql
from sondeframe.plans.registry import _BOXES, _SHA, ORACLE, QUERIES, _boxes, _composite_starts, query
from sondeframe.sources import chunked, clustered, published, readers, sinks
from sondeframe.streaming import fold

_YEARS = "(select distinct cast(year(l_shipdate) as int) y from lineitem where l_shipdate is not null)"
_STARTS = f"(select cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), interval 16 day)) as date) as day from {_YEARS})"


def _line(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/lineitem.parquet")


def _starts(spark, d) -> DataFrame:
    """Each sixteenth day from the first of January, of every year of the table."""
    years = _line(spark, d).select(F.year("l_shipdate").alias("y")).where("y is not null").distinct()
    return years.select(F.explode(F.expr("sequence(make_date(y, 1, 1), make_date(y, 12, 31), interval 16 days)")).alias("day"))


def _corner_sql(at: str, keys: str = "") -> str:
    """Corners with weights of ``at(id, keys, fx, fy, nx, ny)`` within the hull."""
    return f"""(select {keys} id, iy + dy yi, ix + dx xi, (case dy when 1 then fy - iy else 1 - fy + iy end) * (case dx when 1 then fx - ix else 1 - fx + ix end) w
 from (select *, greatest(0, least(floor(fx), nx - 2)) ix, greatest(0, least(floor(fy), ny - 2)) iy from {at} where fx between 0 and nx - 1 and fy between 0 and ny - 1), (select unnest([0, 0, 1, 1]) dy, unnest([0, 1, 0, 1]) dx))"""


# --- composites by tile -------------------------------------------------------------------------------------------
_T = regrid.SINUSOIDAL_TILE
_TILE = "'h' || cast(19 + l_suppkey % 3 as varchar) || 'v05'"
_TILE_N = "(12 + 4 * (l_suppkey % 3))"
_TILED = f"""(select {_TILE} tile, cast(date_trunc('quarter', l_shipdate) as date) fday, cast(l_partkey % {_TILE_N} as int) yi, cast((l_orderkey * 7 + l_linenumber) % {_TILE_N} as int) xi,
 cast(min((l_partkey * 7 + l_orderkey * 3) % 13000 - 2500) as double) v from lineitem where not (l_suppkey % 3 = 1 and quarter(l_shipdate) = 2) group by 1, 2, 3, 4)"""


@query(f"""with px as materialized {_TILED}, files as (select distinct tile, fday from px), d as {_STARTS},
 pick as (select d.day, f.tile, arg_min(f.fday, abs(f.fday - d.day) * 100000 + (f.fday - date '1990-01-01')) fday from d join files f on year(f.fday) = year(d.day) group by 1, 2),
 s as (select id, lon, lat, {C.SINUSOIDAL_R} * radians(lon) * cos(radians(lat)) x, {C.SINUSOIDAL_R} * radians(lat) y from {sql('site')}),
 g as (select id, 'h' || cast(h as varchar) || 'v05' tile, n nx, n ny, (x - (h - 18) * {_T} - {_T} / n / 2) / ({_T} / n) fx, (y - 4 * {_T} + {_T} / n / 2) / (-{_T} / n) fy from s, (select h, 12 + 4 * (h - 19) n from (select unnest([19, 20, 21]) h))),
 c as materialized (select * from {_corner_sql('g', 'tile,')} where w > 1e-9), n as (select tile, id, count(*) need from c group by 1, 2),
 b as (select c.tile, px.fday, c.id, sum(w * v) v, count(*) got from c join px on px.tile = c.tile and px.yi = c.yi and px.xi = c.xi and px.v between -2000 and 10000 group by 1, 2, 3),
 r as (select pick.day, b.id, max(b.v) v from pick join b on b.tile = pick.tile and b.fday = pick.fday join n on n.tile = b.tile and n.id = b.id and n.need = b.got group by 1, 2)
 select day as "day", cast(floor(lon) as int) cell_lon, cast(floor(lat) as int) cell_lat, cast(count(*) as bigint) n, round(avg(v), 3) v, round(max(v), 3) v_max from r join s using (id) group by 1, 2, 3""")
def modis_by_tile(spark, d):
    """Every composite date over every site: the nearest file of the year for each tile, masked, regridded on the tile's own axes, the largest over tiles."""
    n = 12 + 4 * (F.col("l_suppkey") % 3)
    raw = _line(spark, d).where("not (l_suppkey % 3 = 1 and quarter(l_shipdate) = 2)").select(
        F.format_string("h%02dv05", (19 + F.col("l_suppkey") % 3).cast("int")).alias("tile"), F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("day"),
        (F.col("l_partkey") % n).cast("int").alias("yi"), ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % n).cast("int").alias("xi"),
        ((F.col("l_partkey") * 7 + F.col("l_orderkey") * 3) % 13000 - 2500).alias("v"),
    )
    values = raw.groupBy("tile", "day", "yi", "xi").agg(F.min("v").alias("v")).withColumn("file", F.concat(F.lit("MOD13Q1.A"), F.date_format("day", "yyyyDDD"), F.lit("."), F.col("tile"), F.lit(".tif")))
    files = values.select("tile", "file", "day").distinct()
    pixels = 12 + 4 * (F.substring("tile", 2, 2).cast("int") - 19)
    axes = files.select("tile").distinct().select("tile", *regrid.sinusoidal_axes(F.col("tile"), pixels))
    sites = derived(spark, d, "site")
    out = regrid.tile_indicator(_starts(spark, d), files, values.drop("day"), axes, sites, "MOD13Q1").join(sites, "id")
    return out.groupBy("day", F.floor("lon").cast("int").alias("cell_lon"), F.floor("lat").cast("int").alias("cell_lat")).agg(
        F.count("*").alias("n"), F.round(F.avg("v"), 3).alias("v"), F.round(F.max("v"), 3).alias("v_max"))


# --- a daily field at dates ---------------------------------------------------------------------------------------
_FIELD_AXES = {"x0": 22.0, "dx": 5.0, "nx": 4, "y0": 30.0, "dy": 4.0, "ny": 3}
_HEAT = "273.15 + (l_partkey * 7 + l_linenumber * 13) % 400 / 10.0"
_DAILY_MAX = f"(select cast(l_shipdate as date) step, cast(l_partkey % 3 as int) yi, cast(l_suppkey % 4 as int) xi, max({_HEAT} - 273.15) v from lineitem where day(l_shipdate) % 4 <> 0 group by 1, 2, 3)"
_FIELD_AT = f"(select id, (lon - 22) / 5.0 fx, (lat - 30) / 4.0 fy, 4 nx, 3 ny from {sql('site')})"


@query(f"""with f as materialized {_DAILY_MAX}, st as (select distinct step from f), d as (select day from {_STARTS} where date_trunc('month', day) in (select date_trunc('month', step) from st)),
 pick as (select d.day, arg_min(step, abs(step - d.day) * 100000 - (step - date '1990-01-01')) step from d join st on date_trunc('month', step) = date_trunc('month', d.day) group by 1),
 c as materialized (select * from {_corner_sql(_FIELD_AT)} where w > 1e-9), n as (select id, count(*) need from c group by 1),
 b as (select f.step, c.id, sum(w * v) v, count(*) got from c join f using (yi, xi) group by 1, 2)
 select day as "day", cast(floor(lon) as int) cell_lon, cast(count(*) as bigint) n, round(avg(v), 4) tmax from pick join b using (step) join n on n.id = b.id and need = got join {sql('site')} s on s.id = b.id group by 1, 2""")
def daily_max_regridded(spark, d):
    """Daily maximum at each composite date: the month's nearest day that has data, then bilinear at the sites."""
    line = _line(spark, d).where("day(l_shipdate) % 4 <> 0")
    heat = 273.15 + (F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % 400 / 10.0
    hours = line.select(F.to_date("l_shipdate").alias("day"), (F.col("l_partkey") % 3).cast("int").alias("yi"), (F.col("l_suppkey") % 4).cast("int").alias("xi"), (heat - C.KELVIN).alias("t"))
    daily = hours.groupBy("day", "yi", "xi").agg(F.max("t").alias("v"))
    dates = _starts(spark, d).withColumn("m", F.trunc("day", "month")).join(daily.select(F.trunc("day", "month").alias("m")), "m", "left_semi").select("day")
    sites = derived(spark, d, "site")
    out = regrid.field_on(dates, daily, _FIELD_AXES, sites).join(sites, "id")
    return out.groupBy("day", F.floor("lon").cast("int").alias("cell_lon")).agg(F.count("*").alias("n"), F.round(F.avg("v"), 4).alias("tmax"))


# --- a scene's grid -----------------------------------------------------------------------------------------------
_GRID = {"east": 260000.0, "north": 4020000.0, "zone": 36, "rows": 12, "cols": 9, "res": 50000.0}


def _grid_sql() -> str:
    rows = []
    for k in range(_GRID["rows"] * _GRID["cols"]):
        y, x = divmod(k, _GRID["cols"])
        lon, lat = utm.inverse(_GRID["east"] + (x + 0.5) * _GRID["res"], _GRID["north"] - (y + 0.5) * _GRID["res"], _GRID["zone"], m=math)
        rows.append(f"({k}, {lon!r}, {lat!r})")
    return f"(select * from (values {', '.join(rows)}) v(id, lon, lat))"


_SMOKE = "day(l_shipdate) % 10 = 1 and l_linenumber <= 3"
_FILE = f"case when {_SMOKE} then 'era5_day_' || strftime(l_shipdate, '%Y-%m-%d') else 'era5_month_' || strftime(l_shipdate, '%Y-%m') end"
_STEPS = f"(select {_FILE} file, cast(l_shipdate as date) as day, cast(l_partkey % 3 as int) yi, cast(l_suppkey % 4 as int) xi, l_quantity + 0.5 v from lineitem)"
_SCENE_AT = f"(select id, (lon - 22) / 5.0 fx, (lat - 30) / 4.0 fy, 4 nx, 3 ny from {_grid_sql()})"


@query(f"""with v as materialized {_STEPS}, files as (select file, min(day) a, max(day) b from v group by 1), pick as (select d.day, min(file) file from {_STARTS} d join files on d.day between a and b group by 1),
 m as (select file, day, yi, xi, avg(v) v from v semi join pick using (file, day) group by 1, 2, 3, 4), c as materialized (select * from {_corner_sql(_SCENE_AT)} where w > 1e-9), n as (select id, count(*) need from c group by 1)
 select day as "day", file, cast(b.id as bigint) id, round(v, 4) v from (select file, day, c.id, sum(w * v) v, count(*) got from c join m using (yi, xi) group by 1, 2, 3) b join n on n.id = b.id and need = got""")
def matched_weather(spark, d):
    """Weather on a scene's UTM grid: for each date the first file by name that covers it, its daily mean, inverse-projected pixels."""
    line = _line(spark, d)
    smoke = (F.dayofmonth("l_shipdate") % 10 == 1) & (F.col("l_linenumber") <= 3)
    file = F.when(smoke, F.concat(F.lit("era5_day_"), F.date_format("l_shipdate", "yyyy-MM-dd"))).otherwise(F.concat(F.lit("era5_month_"), F.date_format("l_shipdate", "yyyy-MM")))
    values = line.select(file.alias("file"), F.to_date("l_shipdate").alias("day"), (F.col("l_partkey") % 3).cast("int").alias("yi"), (F.col("l_suppkey") % 4).cast("int").alias("xi"), (F.col("l_quantity") + 0.5).alias("v"))
    files = values.groupBy("file").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    out = regrid.matched_daily(_starts(spark, d), files, values, _FIELD_AXES, regrid.utm_pixels(spark, **_GRID))
    return out.select("day", "file", "id", F.round("v", 4).alias("v"))


_MOSAIC_AXES = {"x0": 1900000.0, "dx": 60000.0, "nx": 28, "y0": 4150000.0, "dy": -60000.0, "ny": 16}
_MOSAIC = "(select cast(date_trunc('quarter', l_shipdate) as date) as day, cast(l_suppkey % 3 as int) tile, cast(l_partkey % 16 as int) yi, cast((l_orderkey + l_suppkey) % 28 as int) xi, max(case when l_linenumber = 7 then -3000 else l_quantity end) v from lineitem where not (quarter(l_shipdate) = 1 and year(l_shipdate) % 2 = 0) group by 1, 2, 3, 4)"
_MOSAIC_AT = f"(select id, ({C.SINUSOIDAL_R} * radians(lon) * cos(radians(lat)) - 1900000) / 60000.0 fx, ({C.SINUSOIDAL_R} * radians(lat) - 4150000) / -60000.0 fy, 28 nx, 16 ny from {_grid_sql()})"
_REFS = "(select distinct cast(date_trunc('month', o_orderdate) as date) + 14 as ref from orders)"


@query(f"""with t as materialized {_MOSAIC}, comp as (select distinct day from t),
 pick as (select ref, coalesce(max(day) filter (day <= ref), min(day)) as day from {_REFS} join comp on year(day) = year(ref) group by 1),
 m as materialized (select day, yi, xi, arg_min(v, tile) v from t where v <> -3000 and day in (select day from pick) group by 1, 2, 3), c as materialized (select * from {_corner_sql(_MOSAIC_AT)} where w > 1e-9), n as (select id, count(*) need from c group by 1),
 b as (select day, c.id, sum(w * v) v, count(*) got from c join m using (yi, xi) group by 1, 2)
 select ref, pick.day composite, cast(count(*) as bigint) n, round(avg(v), 4) v, round(min(v), 4) v_min from pick join b on b.day = pick.day join n on n.id = b.id and need = got group by 1, 2""")
def matched_mosaics(spark, d):
    """Composites on the scene's grid: the latest of the reference date's year (else its first), overlapping tiles merged before the regrid."""
    refs = spark.read.parquet(f"{d}/orders.parquet").select(F.date_add(F.trunc("o_orderdate", "month"), 14).alias("day")).where("day is not null").distinct()
    line = _line(spark, d).where("not (quarter(l_shipdate) = 1 and year(l_shipdate) % 2 = 0)")
    v = F.max(F.when(F.col("l_linenumber") == 7, -3000).otherwise(F.col("l_quantity"))).alias("v")
    tiles = line.groupBy(F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("composite"), (F.col("l_suppkey") % 3).cast("int").alias("tile"), (F.col("l_partkey") % 16).cast("int").alias("yi"),
                         ((F.col("l_orderkey") + F.col("l_suppkey")) % 28).cast("int").alias("xi")).agg(v)
    marks = tiles.select(F.col("composite").alias("day"), F.year("composite").alias("year")).distinct()
    pick = joins.as_of(refs.withColumn("year", F.year("day")), marks, ["year"], "day", "composite").where("composite is not null")
    used = tiles.join(pick.select("composite").distinct(), "composite", "left_semi")
    got = regrid.matched_mosaic(used, ["composite"], _MOSAIC_AXES, regrid.utm_pixels(spark, **_GRID), nodata=-3000)
    out = pick.join(got, "composite").groupBy(F.col("day").alias("ref"), "composite")
    return out.agg(F.count("*").alias("n"), F.round(F.avg("v"), 4).alias("v"), F.round(F.min("v"), 4).alias("v_min"))


# --- windows of label rasters -------------------------------------------------------------------------------------
_X, _Y = (22.025, 0.05, 280), (30.025, 0.05, 140)
_YEARLY = "(select cast(date_trunc('year', l_shipdate) as date) as day, cast((l_partkey * 31 + l_linenumber) % 140 as int) yi, cast((l_orderkey * 17 + l_suppkey) % 280 as int) xi, cast(case when l_linenumber = 7 then 255 else l_quantity % 4 end as int) cls from lineitem)"


@query(f"""with cells as (select bid, cast(k // 16 as int) r, cast(k % 16 as int) c, w + (k % 16) * ((e - w) / 16) cw, s + (k // 16) * ((n - s) / 16) cs, w + (k % 16 + 1) * ((e - w) / 16) ce, s + (k // 16 + 1) * ((n - s) / 16) cn from {_BOXES}, (select unnest(range(256)) k)),
 xs as (select i, {_X[0]} + i * {_X[1]} c from range(0, {_X[2]}) t(i)), ys as (select i, {_Y[0]} + i * {_Y[1]} c from range(0, {_Y[2]}) t(i)),
 inn as (select bid, r, cells.c, xs.i xi, ys.i yi from cells join xs on xs.c between cw and ce join ys on ys.c between cs and cn),
 px as (select * from inn union all select bid, r, c, (select arg_min(i, abs(xs.c - (cw + ce) / 2)) from xs), (select arg_min(i, abs(ys.c - (cs + cn) / 2)) from ys) from cells where (bid, r, c) not in (select (bid, r, c) from inn)),
 lab as materialized {_YEARLY}, days as (select distinct day from lab),
 p as (select bid, day, r, c, max(lab.cls) filter (lab.cls <> 255) cls from px cross join days left join lab using (day, xi, yi) group by 1, 2, 3, 4),
 k as (select *, cast(bid as varchar) || '_' || cast(day as varchar) || '_r' || lpad(cast(r as varchar), 2, '0') || 'c' || lpad(cast(c as varchar), 2, '0') sid from p),
 q as (select *, cls is not null and (cls = 3 or {_SHA.format('sid')} < case cls when 0 then 0.015 when 1 then 0.04 when 2 then 0.4 else 0 end) kept from k)
 select bid tile, day as "day", cast(count(*) as bigint) n_windows, cast(count(*) filter (cls is null) as bigint) n_nodata, cast(count(*) filter (kept) as bigint) n_kept, cast(count(*) filter (kept and cls = 3) as bigint) n_kept_3,
 cast(coalesce(sum((r * 16 + c) * (cls + 1)) filter (kept), 0) as bigint) digest, cast(coalesce(sum((r * 16 + c) * (cls + 1)), 0) as bigint) classes from q group by 1, 2""")
def window_decisions(spark, d):
    """Tiles x label years x 256 windows: class by prefix sums, seeded decision, summed up with digests of place and class."""
    line = _line(spark, d)
    labels = line.select(F.to_date(F.date_trunc("year", "l_shipdate")).alias("day"), ((F.col("l_partkey") * 31 + F.col("l_linenumber")) % 140).cast("int").alias("yi"),
                         ((F.col("l_orderkey") * 17 + F.col("l_suppkey")) % 280).cast("int").alias("xi"), F.when(F.col("l_linenumber") == 7, 255).otherwise((F.col("l_quantity") % 4).cast("int")).alias("cls"))
    sid = names.sample_id(F.col("tile").cast("string"), F.col("day"), F.col("row"), F.col("col"))
    out = prefix.decide_windows(_boxes(spark, d).withColumnRenamed("bid", "id"), labels, _X, _Y, sid)
    place = ((F.col("row") * 16 + F.col("col")) * (F.col("cls") + 1)).cast("long")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return out.groupBy("tile", "day").agg(F.count("*").alias("n_windows"), F.count_if(F.col("cls").isNull()).alias("n_nodata"), F.count_if("kept").alias("n_kept"), F.count_if(F.col("kept") & (F.col("cls") == 3)).alias("n_kept_3"),
                                          total(F.when(F.col("kept"), place)).alias("digest"), total(place).alias("classes"))


# --- label patches ------------------------------------------------------------------------------------------------
@query()
def tile_labels(spark, d):
    """Classes of the 224 x 224 pixels of 30 m around every site, from the label raster active on the site's day."""
    line = _line(spark, d)
    labels = line.select(F.to_date(F.date_trunc("year", "l_shipdate")).alias("label_date"), ((F.col("l_partkey") * 31 + F.col("l_linenumber")) % 140).cast("int").alias("lat_i"),
                         ((F.col("l_orderkey") * 17 + F.col("l_suppkey")) % 280).cast("int").alias("lon_i"), F.when(F.col("l_linenumber") == 7, 255).otherwise((F.col("l_quantity") % 4).cast("int")).alias("cls"))
    sites = derived(spark, d, "site").withColumn("day", F.date_add(F.lit("1994-06-01").cast("date"), (F.col("id") * 13 % 3000).cast("int")))
    dated = joins.as_of_small(sites, labels.select(F.col("label_date").alias("day")).distinct(), "day", "label_date")
    return patches.label_counts(dated, labels, ["label_date"], (30.0, 0.05, 140), (22.0, 0.05, 280))


# --- stores and streams -------------------------------------------------------------------------------------------
_BASE_YEAR = 1990


@query(f"""select cast(year(day) as int) "year", yi // 20 * 20 lat_from, cast(cls as int) cls, cast(count(*) as bigint) n from (select day, yi, xi, max(cls) cls from {_YEARLY} where cls <> 255 group by 1, 2, 3)
 where yi between 10 and 95 and xi between 100 and 219 group by 1, 2, 3""")
def label_store(spark, d):
    """Label rasters as a chunked array of (year, lat, lon), written, and read by the data source: a box touches some chunks only."""
    line = _line(spark, d).where("l_linenumber <> 7")
    labels = line.select((F.year("l_shipdate") - _BASE_YEAR).cast("long").alias("year"), ((F.col("l_partkey") * 31 + F.col("l_linenumber")) % 140).alias("lat"),
                         ((F.col("l_orderkey") * 17 + F.col("l_suppkey")) % 280).alias("lon"), (F.col("l_quantity") % 4).cast("int").alias("value")).where("year is not null")
    store = fold._folder(spark)
    chunked.create_array(store, "label", ["year", "lat", "lon"], [40, 140, 280], [1, 70, 70], "u1", C.NODATA)
    chunked.write_array(labels, store, "label")
    box = chunked.read_array(spark, store, "label").where("lat >= 10 and lat <= 95 and lon >= 100 and lon <= 219 and value is not null")
    year = (F.col("year") + _BASE_YEAR).cast("int").alias("year")
    return box.groupBy(year, (F.floor(F.col("lat") / 20) * 20).cast("int").alias("lat_from"), F.col("value").cast("int").alias("cls")).agg(F.count("*").alias("n"))


@query(f"""select o_orderkey k, o_totalprice v from (select *, 22 + cast((o_custkey * 37) % 1400 as double) / 100 lon, 30 + cast((o_custkey * o_custkey) % 701 as double) / 100 lat from orders)
 where lon between {C.DELTA[0]} and {C.DELTA[2]} and lat between {C.DELTA[1]} and {C.DELTA[3]}""")
def clustered_box(spark, d):
    """Orders as points, written along the curve, and a box read back through the bounds of row groups."""
    at = {"lon": "22 + cast((o_custkey * 37) % 1400 as double) / 100", "lat": "30 + cast((o_custkey * o_custkey) % 701 as double) / 100"}
    points = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as k", "o_totalprice as v", *[f"{e} as {c}" for c, e in at.items()])
    path = fold._folder(spark)
    clustered.write_clustered(points, path, group_bytes=1 << 20)
    return readers.read_box(spark, path, C.DELTA).select("k", "v")


@query(f"""select cell, cast(ts as date) "day", cast(count(t2m) as bigint) n, round(avg(t2m), 6) "mean", round(min(t2m), 6) low, round(max(t2m), 6) high from {sql('hourly')}
 group by 1, 2 having cast(ts as date) + 1 <= (select max(ts) - interval 1 day from {sql('hourly')})""")
def streamed_days(spark, d):
    """Hourly values that arrive in four files, up to eighteen hours late, as daily windows by event time; days still open are not put out."""
    h = derived(spark, d, "hourly").select("cell", "ts", F.col("t2m").alias("value"), F.expr("ts + make_interval(0, 0, 0, 0, cast(crc32(cast(cast(ts as string) as binary)) % 19 as int))").alias("_arrived"))
    ends = h.agg(F.min("_arrived").alias("a"), F.max("_arrived").alias("b")).first()
    base = fold._folder(spark)
    if ends["a"] is not None:
        step = (ends["b"] - ends["a"]) / 4
        for k in range(4):  # one after the other, so that they arrive in this order
            own = (F.col("_arrived") >= ends["a"] + k * step) & ((F.col("_arrived") < ends["a"] + (k + 1) * step) if k < 3 else F.lit(True))
            h.where(own).drop("_arrived").coalesce(1).write.mode("append").parquet(f"{base}/in")
        fold.stream_days(spark, f"{base}/in", h.drop("_arrived").schema, ["cell"], f"{base}/out", f"{base}/checkpoint")
    days = published.read_published(spark, f"{base}/out", fold.daily_windows(h, ["cell"]).schema)
    return days.select("cell", "day", "n", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")])


@query(f"""select 'doy' kind, cell, doy "key", mean, std, n from ({ORACLE["circular_doy_stats"]}) union all select 'month', cell, "month", wb_mean, wb_std, null from ({ORACLE["water_balance_stats"]})
 union all select 'monthly', cast(l_suppkey % 20 as int), cast(year(l_shipdate) * 100 + month(l_shipdate) as int), round(sum(l_extendedprice) / 1e6, 5), null, null from lineitem group by 2, 3""")
def climatology_tables(spark, d):
    """Statistics by day of year and month, and monthly sums, written as one climatology and read back."""
    pet = monthly(spark, d, "pet").withColumnRenamed("pet", "total").withColumn("total", F.round("total", 5))
    path = fold._folder(spark)
    sinks.write_climatology(path, QUERIES["circular_doy_stats"](spark, d), QUERIES["water_balance_stats"](spark, d), pet)
    return readers.read_table(spark, path, "parquet", sinks.CLIMATOLOGY)


@query(f"""select 'disk' source, "day", sensor, path item from ({ORACLE["disk_scenes"]}) union all select 'window', "day", 'S30', id from ({ORACLE["one_scene_per_window_all_years"]}) union all select 'date', "day", 'S30', id from ({ORACLE["first_scene_per_date"]})""")
def resolved_scenes(spark, d):
    """The three ways to choose scenes, over the same table."""
    s = derived(spark, d, "scene")
    links = F.when(names.sensor_of(F.col("id")) == "S30", F.lit("x"))
    paths = s.select(F.concat("id", F.lit(".B04.tif")).alias("path"))
    kinds = {"disk": catalog.resolve_scenes(paths, "disk"), "window": catalog.resolve_scenes(s, "catalog", links, _composite_starts(s.select(F.year("day").alias("year")), "start")), "date": catalog.resolve_scenes(s, "catalog", links)}
    parts = [v.select(F.lit(k).alias("source"), "day", "sensor", "item") for k, v in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""with m as (select distinct cast(unnest(generate_series(date_trunc('month', cast(o_orderdate as date) - 89), date_trunc('month', o_orderdate), interval 1 month)) as date) m from orders where o_orderdate is not null)
 select cast(year(m) as int) "year", cast(month(m) as int) "month", printf('precip.%04d.%02d.nc', cast(year(m) as int), cast(month(m) as int)) file, m in (select cast(date_trunc('month', l_shipdate) as date) from lineitem) there from m""")
def season_inputs(spark, d):
    """The month files that the ninety days before any order touch, and whether their data exist."""
    ends = spark.read.parquet(f"{d}/orders.parquet").select(F.to_date("o_orderdate").alias("end")).where("end is not null")
    months = readers.months_spanning(ends, "end")
    held = _line(spark, d).select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).distinct().withColumn("there", F.lit(True))
    return months.join(held, ["year", "month"], "left").select("year", "month", names.month_file(F.col("year"), F.col("month")).alias("file"), F.coalesce("there", F.lit(False)).alias("there"))
