"""Further registered queries: names and dates, scans and sinks, pixel windows, series, acceptance."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import dates, geo, names
from sondeframe.operators import aggregates as A
from sondeframe.operators import catalog, dataset, grid, joins
from sondeframe.plans.derived import derived, sql
from sondeframe.plans.registry import query, r6
from sondeframe.sources import readers, sinks
from sondeframe.streaming.fold import _folder


def _folder_of(spark: SparkSession, name: str) -> str:
    return os.path.join(_folder(spark), f"{name}-{uuid.uuid4().hex}")


def _names(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return spark.read.parquet(f"{d}/orders.parquet").select(
        k.alias("k"), F.format_string("MOD13Q1.A%s.h%02dv%02d.%s.tif", F.date_format("o_orderdate", "yyyyDDD"), (k % 36).cast("int"), (k % 18).cast("int"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("name"),
        F.to_date("o_orderdate").alias("day"),
    )


@query("""select o_orderkey k, cast(year(o_orderdate) as int) "year", cast(dayofyear(o_orderdate) as int) doy, printf('h%02dv%02d', cast(o_orderkey % 36 as int), cast(o_orderkey % 18 as int)) grid_tile,
 cast(o_orderdate as date) label_date, true terra, 'x.B8A.' || o_orderkey || '.tif' nir, printf('precip.%04d.%02d.nc', cast(year(o_orderdate) as int), cast(month(o_orderdate) as int)) month_file from orders""")
def parsed_file_names(spark, d):
    year, doy = names.composite_year_doy(F.col("name"))
    nir = names.band_path(F.concat(F.lit("x.B04."), F.col("k").cast("string"), F.lit(".tif")), "B8A")
    return _names(spark, d).select(
        "k", year.alias("year"), doy.alias("doy"), names.grid_tile(F.col("name")).alias("grid_tile"), names.label_date(F.col("name")).alias("label_date"),
        names.is_terra(F.col("name")).alias("terra"), nir.alias("nir"), names.month_file(F.year("day"), F.month("day")).alias("month_file"),
    )


@query(f"""select id, day from (select *, cast(k % 14 as double) + 22 lon, cast(k % 7 as double) + 30 lat from {sql('scene')})
 where cloud < 50 and day between date '1996-03-01' and date '1997-08-31' and lon between 24 and 30 and lat between 31 and 35 order by day, id limit 200""")
def catalog_search_box(spark, d):
    s = derived(spark, d, "scene").withColumn("lon", F.col("k") % 14 + 22.0).withColumn("lat", F.col("k") % 7 + 30.0)
    parts = [s.where(F.col("id").contains(f".{c}.")) for c in ("S30", "L30")]
    return catalog.search_all(parts, "T36RUU", "1996-03-01", "1997-08-31", (24, 31, 30, 35), most=200).select("id", "day")


@query("""select cast(year(l_shipdate) as int) "year", cast(month(l_shipdate) as int) "month", cast(count(distinct cast(l_shipdate as date)) as bigint) "days",
 count(distinct cast(l_shipdate as date)) = max(day(last_day(l_shipdate))) and count(case when l_linenumber < 7 then 1 end) > 0 valid from lineitem group by 1, 2""")
def month_validity(spark, d):
    df = spark.read.parquet(f"{d}/lineitem.parquet").select("l_shipdate", F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("v"))
    return readers.whole_months(df, "l_shipdate", "v").select(F.col("year").cast("int"), F.col("month").cast("int"), F.col("days").cast("bigint"), "valid")


@query("""select o_orderkey k, o_totalprice v from orders where year(o_orderdate) * 100 + month(o_orderdate) in (199602, 199611, 199701)""")
def month_partitions(spark, d):
    """Written by month and read back with only the wanted partitions scanned."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    path = _folder_of(spark, "months")
    sinks.overwrite_partitions(o.repartition("year", "month"), path, ("year", "month"))
    return readers.read_months(spark, path, [(1996, 2), (1996, 11), (1997, 1)]).select("k", "v")


@query(f"""select id from (select c_custkey id, 22 + cast((c_custkey * 37) % 1400 as double) / 100 lon, 30 + cast((c_custkey * c_custkey) % 701 as double) / 100 lat, 2015 + c_custkey % 8 y from customer)
 where lon between {C.DELTA[0]} and {C.DELTA[2]} and lat between {C.DELTA[1]} and {C.DELTA[3]} and y between 2017 and 2020""")
def box_scan(spark, d):
    s = derived(spark, d, "site").withColumn("valid_time", F.make_date(F.lit(2015) + (F.col("id") % 8).cast("int"), F.lit(6), F.lit(1)))
    path = _folder_of(spark, "grid")
    s.withColumnRenamed("lon", "longitude").withColumnRenamed("lat", "latitude").write.parquet(path)
    return readers.read_box(spark, path, C.DELTA, (2017, 2020)).select("id")


@query(f"""select id from (select case when c_custkey % 3 = 0 then 'MYD' when c_custkey % 3 = 1 then 'MOD' else 'mod' end || c_custkey id, lon, lat from {sql('site')} join customer on id = c_custkey)
 where upper(id) like 'MOD%' and lon - 0.5 <= {C.DELTA[2]} and lon + 0.5 >= {C.DELTA[0]} and lat - 0.5 <= {C.DELTA[3]} and lat + 0.5 >= {C.DELTA[1]}""")
def terra_items(spark, d):
    k = F.col("id")
    s = derived(spark, d, "site").withColumn("id", F.concat(F.when(k % 3 == 0, "MYD").when(k % 3 == 1, "MOD").otherwise("mod"), k.cast("string")))
    half = F.lit(0.5)
    items = s.select("id", (F.col("lon") - half).alias("w"), (F.col("lon") + half).alias("e"), (F.col("lat") - half).alias("s"), (F.col("lat") + half).alias("n"))
    return readers.terra_scenes(items, C.DELTA).select("id")


@query(f"""select min(id) "path", 'any' want from {sql('scene')} union all select min(id), 'dated' from {sql('scene')} where day = (select max(day) from {sql('scene')})""")
def reference_scene(spark, d):
    s = derived(spark, d, "scene")
    last = s.agg(F.max("day").cast("string").alias("day")).first()["day"]
    paths = s.select(F.col("id").alias("path"))
    pick = lambda want, name: catalog.find_reference(paths, want).select("path", F.lit(name).alias("want"))
    return pick(None, "any").unionByName(pick(last, "dated"))


_PATCH_BOXES = "(select s_suppkey bid, 22 + s_suppkey % 13 + 0.013 w, 30 + s_suppkey % 6 + 0.017 s, 22 + s_suppkey % 13 + 0.013 + (s_suppkey % 3) * 0.03 e, 30 + s_suppkey % 6 + 0.017 + (s_suppkey % 5) * 0.03 n from supplier)"
_AXIS_X, _AXIS_Y = (22.025, 0.05, 280), (30.025, 0.05, 140)


@query(f"""with b as {_PATCH_BOXES}, xs as (select i, {_AXIS_X[0]} + i * {_AXIS_X[1]} c from range(0, 280) t(i)), ys as (select i, {_AXIS_Y[0]} + i * {_AXIS_Y[1]} c from range(0, 140) t(i)),
 inn as (select bid, xs.i xi, ys.i yi from b join xs on xs.c between w and e join ys on ys.c between s and n)
 select bid, cast(xi as bigint) xi, cast(yi as bigint) yi from inn union all
 select bid, (select arg_min(i, abs(c - (w + e) / 2)) from xs), (select arg_min(i, abs(c - (s + n) / 2)) from ys) from b where bid not in (select bid from inn)""")
def label_windows(spark, d):
    k = F.col("s_suppkey")
    w, s = 22 + k % 13 + 0.013, 30 + k % 6 + 0.017
    b = spark.read.parquet(f"{d}/supplier.parquet").select(k.alias("bid"), w.alias("w"), s.alias("s"), (w + (k % 3) * 0.03).alias("e"), (s + (k % 5) * 0.03).alias("n"))
    return grid.box_pixels(b, _AXIS_X, _AXIS_Y).select("bid", "xi", "yi")


_METHODS = ("mean", "sum", "max", "min")


@query(f"""select cell, cast(ts as date) "day", round(avg(t2m), 6) "mean", round(sum(t2m), 6) "sum", round(max(t2m), 6) "max", round(min(t2m), 6) "min" from {sql('hourly')} group by 1, 2""")
def hourly_methods(spark, d):
    h = derived(spark, d, "hourly")
    return h.groupBy("cell", F.to_date("ts").alias("day")).agg(*[r6(A.aggregate_hourly(F.col("t2m"), m), m) for m in _METHODS])


@query(f"""select cell, cast(ts as date) "day", round(avg(t2m), 6) t2m from {sql('hourly')} group by 1, 2""")
def harmonised_daily_mean(spark, d):
    return A.daily_mean(derived(spark, d, "hourly"), ["cell"], "ts", "t2m").select("cell", "day", r6("t2m", "t2m"))


@query("""select cast(l_suppkey % 20 as int) cell, cast(year(l_shipdate) * 100 + month(l_shipdate) as int) ym, round(coalesce(sum(case when l_linenumber = 7 then l_tax end), 0), 6) total from lineitem group by 1, 2""")
def monthly_totals_zero(spark, d):
    """Sums over months in which a missing month counts as zero."""
    df = spark.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_suppkey") % 20).cast("int").alias("cell"), (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym"), F.when(F.col("l_linenumber") == 7, F.col("l_tax")).alias("v"))
    return A.monthly_sum(df, ["cell", "ym"], F.col("v"), missing_as_zero=True).select("cell", "ym", r6("total", "total"))


@query(f"""select tile, "day", cast(count(*) as bigint) pixels, cast(count(*) filter (cls <= 3) as bigint) labelled, round(count(*) filter (cls <= 3) / count(*), 6) coverage, round(count(*) filter (cls <> 255) / count(*), 6) valid from {sql('label')} group by 1, 2""")
def label_coverage(spark, d):
    df = derived(spark, d, "label")
    valid = df.groupBy("tile", "day").agg(r6(A.valid_fraction(F.col("cls"), C.NODATA), "valid"))
    return A.land_coverage(df, ["tile", "day"], F.col("cls")).withColumn("coverage", F.round("coverage", 6)).join(valid, ["tile", "day"])


_POOL = f"(select cls, cast(count(*) as bigint) n from {sql('label')} where cls <= 3 group by 1)"


@query(f"""select cls, n, round((select median(n) from {_POOL}) / n, 6) weight, round((select sum(n) from {_POOL} where cls = 3) / (select sum(n) from {_POOL}), 6) compound_fraction from {_POOL}""")
def pooled_class_weights(spark, d):
    return A.pooled_weights(derived(spark, d, "label"), F.col("cls")).select("cls", "n", r6("weight", "weight"), r6("compound_fraction", "compound_fraction"))


_IN_TRAIN = f"(select * from {sql('hourly')} h where exists (select 1 from {sql('indexed')} i where i.split = 'train' and cast(i.sample_id as bigint) % 16 = h.cell))"


@query(f"""select 't2m' channel, round(avg(t2m), 6) "mean", round(stddev_pop(t2m), 5) "std" from {_IN_TRAIN} union all select 'tp', round(avg(tp), 6), round(stddev_pop(tp), 5) from {_IN_TRAIN}""")
def train_index_stats(spark, d):
    """Channel statistics over the series that the index's training rows use, by a semi join."""
    train = dataset.members(derived(spark, d, "indexed"))[0].where("split = 'train'").select((F.col("sample_id").cast("long") % 16).cast("int").alias("cell"))
    h = derived(spark, d, "hourly").join(train, "cell", "left_semi")
    long = h.select(F.explode(F.create_map(F.lit("t2m"), F.col("t2m"), F.lit("tp"), F.col("tp"))).alias("channel", "value"))
    return A.channel_stats(long, ("t2m", "tp")).select("channel", r6("mean", "mean"), F.round("std", 5).alias("std"))


@query(f"""select case when year("day") between 2017 and 2022 then 'train' when year("day") = 2023 then 'test' when year("day") = 2024 then 'ood_time' else 'none' end part, cast(count(*) as bigint) n from (select "day" + interval 22 year "day" from {sql('indexed')}) group by 1""")
def temporal_split_counts(spark, d):
    from sondeframe.operators.splits import temporal_split

    return derived(spark, d, "indexed").groupBy(temporal_split(F.year(F.add_months("day", 12 * 22))).alias("part")).agg(F.count("*").alias("n"))


@query(f"""select region, cast(count(*) as bigint) n, round(avg(cloud_pct), 6) cloud_pct, round(avg(valid_pct), 6) valid_pct from {sql('indexed')} group by 1""")
def tile_summary(spark, d):
    return A.tile_summary(derived(spark, d, "indexed"), ["region"]).select("region", "n", r6("cloud_pct", "cloud_pct"), r6("valid_pct", "valid_pct"))


@query("""select o_orderkey k, strftime(m, '%Y-%m') "month", cast(m as date) first_day, last_day(m) last_day, cast(datediff('day', o_orderdate, o_orderdate + to_days(cast(o_custkey % 40 as int))) + 1 as bigint) "days" from
 (select *, unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', o_orderdate + to_days(cast(o_custkey % 40 as int))), interval 1 month)) m from orders)""")
def month_and_day_spines(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 40).cast("int")).alias("b"))
    o = o.withColumn("month", F.explode(dates.month_names(F.col("a"), F.col("b"))))
    first, last = dates.month_bounds(F.col("month"))
    return o.select("k", "month", first.alias("first_day"), last.alias("last_day"), F.size(dates.days_between(F.col("a"), F.col("b"))).cast("bigint").alias("days"))


@query("""select event_id, coalesce(case when event_id % 3 <> 0 then cast(ts as date) end, case when event_id % 5 <> 0 then cast(ts as date) end) "day" from events where lower(event_type) in ('click', 'view', 'purchase')""")
def item_dates(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").where(dates.chosen(F.col("event_type"), "Click, view,PURCHASE ,"))
    text = F.when(F.col("event_id") % 5 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("no date here")
    return e.select("event_id", dates.item_date(F.when(F.col("event_id") % 3 != 0, F.col("ts")), text).alias("day"))


_SERIES_END = "date '2024-01-31'"


@query(f"""with h as (select cell, cast(ts as date) "day", avg(t2m) t2m, max(t2m) tmax from {sql('hourly')} group by 1, 2), r as (select cell, cast(ts as date) "day", sum(tp) tp from {sql('hourly')} where extract('day' from ts) % 3 <> 0 group by 1, 2),
 e as (select cell, max("day") "end" from h group by 1), s as (select cell, unnest(generate_series(e."end" - 89, e."end", interval 1 day)) "day" from e)
 select cast(s.cell as varchar) sample_id, cast(90 as bigint) "days", cast(min(s."day") as date) first_day, cast(count(t2m) as bigint) n_t2m, cast(count(tp) as bigint) n_tp, round(sum(tmax), 1) sum_tmax, round(sum(tp), 3) sum_tp
 from s left join h on h.cell = s.cell and h."day" = s."day" left join r on r.cell = s.cell and r."day" = s."day" group by 1, 2""")
def packed_series(spark, d):
    """Ninety days by channel from two sources, as one array a sample; summed for the comparison."""
    h = derived(spark, d, "hourly")
    heat = h.groupBy("cell", F.to_date("ts").alias("day")).agg(F.avg("t2m").alias("t2m"), F.max("t2m").alias("tmax"))
    rain = h.where(F.dayofmonth("ts") % 3 != 0).groupBy("cell", F.to_date("ts").alias("day")).agg(F.sum("tp").alias("precip"))
    samples = heat.groupBy("cell").agg(F.max("day").alias("end")).withColumn("sample_id", F.col("cell").cast("string"))
    out = dataset.dense_series(samples, [heat, rain], ["cell"], ["t2m", "tmax", "precip"])
    column = lambda i: F.filter(F.transform("meteo", lambda v: v[i].cast("double")), lambda x: x.isNotNull())
    total = lambda i: F.aggregate(column(i), F.lit(0.0), lambda a, x: a + x)
    return out.select("sample_id", F.size("days").cast("bigint").alias("days"), F.get("days", F.lit(0)).alias("first_day"), F.size(column(0)).cast("bigint").alias("n_t2m"),
                      F.size(column(2)).cast("bigint").alias("n_tp"), F.round(total(1), 1).alias("sum_tmax"), F.round(total(2), 3).alias("sum_tp"))


_KM = "2 * 6371.0088 * asin(least(1, sqrt(pow(sin(radians(b.center_lat - a.center_lat) / 2), 2) + cos(radians(a.center_lat)) * cos(radians(b.center_lat)) * pow(sin(radians(b.center_lon - a.center_lon) / 2), 2))))"
_LEAKS = f"(select a.sample_id near_id, b.sample_id far_id from {sql('indexed')} a join {sql('indexed')} b on a.split = 'test' and b.split = 'train' and {_KM} < 25)"
_SHARED = f"""(select "day", cast(count(*) as bigint) n from {sql('indexed')} where split in ('test', 'train') group by 1 having count(distinct split) > 1)"""
_BAD = f"""(select sample_id from {sql('indexed')} where not (coalesce(center_lat between -90 and 90, false) and coalesce(center_lon between -180 and 180, false) and coalesce(cloud_pct between 0 and 1, false) and coalesce(valid_pct between 0 and 1, false)
 and coalesce(region in ('em_shelf', 'delta', 'n_coast', 'ood_nw_africa'), false) and coalesce(split in ('train', 'val', 'test', 'ood', 'buffer', 'none'), false)))"""


@query(f"select near_id, far_id from {_LEAKS}")
def spatial_leak_pairs(spark, d):
    return dataset.spatial_leaks(derived(spark, d, "indexed")).select("near_id", "far_id")


@query(f'select "day", n from {_SHARED}')
def shared_split_dates(spark, d):
    return dataset.dates_in_both(derived(spark, d, "indexed"))


@query(f"""select 'schema' "check", cast(count(*) as bigint) found, count(*) = 0 passed from {_BAD} union all select 'spatial', cast(count(*) as bigint), count(*) = 0 from {_LEAKS} union all select 'temporal', cast(count(*) as bigint), count(*) = 0 from {_SHARED}""")
def acceptance_report(spark, d):
    return dataset.acceptance(derived(spark, d, "indexed"))


_R = C.SINUSOIDAL_R
_XY = f"floor({_R} * radians(lon) * cos(radians(lat)) / 5000)", f"floor({_R} * radians(lat) / 5000)"


@query(f"""select cast({_XY[0]} as bigint) col, cast({_XY[1]} as bigint) "row", max(id % 1000) v from {sql('site')} group by 1, 2""")
def sinusoidal_mosaic(spark, d):
    """Points of overlapping tiles on a sinusoidal grid of 5 km, one value a cell."""
    x, y = geo.sinusoidal(F.col("lon"), F.col("lat"))
    s = derived(spark, d, "site").select(F.floor(x / 5000).alias("col"), F.floor(y / 5000).alias("row"), (F.col("id") % 1000).alias("v"))
    return A.mosaic_max(s, ["col", "row"], "v")


@query(f"select id, round(lon, 6) lon, round(lat, 6) lat from {sql('site')}")
def sinusoidal_round_trip(spark, d):
    x, y = geo.sinusoidal(F.col("lon"), F.col("lat"))
    lon, lat = geo.from_sinusoidal(F.col("x"), F.col("y"))
    return derived(spark, d, "site").select("id", x.alias("x"), y.alias("y")).select("id", r6(lon, "lon"), r6(lat, "lat"))


@query(f"select sample_id, region from {sql('indexed')} where split in ('train', 'test')")
def appended_index(spark, d):
    """Two appends of overlapping samples, read back: each sample is there once."""
    s = derived(spark, d, "indexed").where("split in ('train', 'test')").withColumn("mgrs_tile", F.lit("T36RUU")).withColumn("year", F.year("day"))
    path = _folder_of(spark, "index")
    sinks.append_index(s.where("split = 'train'"), path)
    sinks.append_index(s, path)
    return sinks.read_index(spark, path, s.schema).select("sample_id", "region")


@query(f"""select cls "class", cast(count(*) as bigint) pixels, round(count(*) / sum(count(*)) over (), 6) fraction from {sql('label')} where cls <= 3 group by 1""")
def prevalence_file(spark, d):
    path = _folder_of(spark, "prevalence")
    sinks.write_prevalence(A.class_histogram(derived(spark, d, "label"), F.col("cls")), path)
    out = readers.read_table(spark, path, "csv", "class int, pixels long, fraction double")
    return out.select("class", "pixels", r6("fraction", "fraction"))


@query(f"""select cast(coalesce(cls, 255) as smallint) cls, label_date, cast(count(*) as bigint) n from (select case when l_linenumber = 6 then null when l_linenumber = 7 then 255 else l_quantity % 4 end cls, cast(date_trunc('month', l_shipdate) as date) label_date from lineitem) group by 1, 2""")
def label_grid_file(spark, d):
    df = spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.when(F.col("l_linenumber") != 6, F.when(F.col("l_linenumber") == 7, 255).otherwise((F.col("l_quantity") % 4).cast("int"))).alias("cls"),
        F.to_date(F.date_trunc("month", "l_shipdate")).alias("label_date"), (F.col("l_partkey") % 16).alias("lat_i"), (F.col("l_orderkey") % 16).alias("lon_i"),
    )
    path = _folder_of(spark, "labels")
    sinks.write_label_grid(df, path)
    out = readers.read_table(spark, path, "parquet", "cls short, lat_i long, lon_i long, label_date date")
    return out.groupBy("cls", "label_date").agg(F.count("*").alias("n"))


@query(f"select sample_id, region, center_lon from {sql('indexed')}")
def report_documents(spark, d):
    """Rows as JSON documents, written, and read again as JSON lines."""
    path = _folder_of(spark, "reports")
    sinks.report(derived(spark, d, "indexed").select("sample_id", "region", "center_lon")).write.text(path)
    return readers.read_table(spark, path, "json", "sample_id string, region string, center_lon double")


@query(f"select sample_id, split from {sql('indexed')} where split <> 'none'")
def inside_roi(spark, d):
    return dataset.inside(derived(spark, d, "indexed")).select("sample_id", "split")


_PATCHES = """(select 'T36RUU' mgrs_tile, date '2023-08-01' + cast(user_id % 3 as int) as day, cast((event_id * 7919) % 700 as int) y, cast((event_id * 104729) % 500 as int) x, fmask, red
 from (select event_id, user_id, cast(case when event_id % 13 = 0 then 255 else (event_id * 7) % 64 end as int) fmask, cast(case when event_id % 17 = 0 then -9999 else event_id % 3000 end as int) red from events))"""


@query(f"""select mgrs_tile || '_' || strftime(day, '%Y-%m-%d') || printf('_r%02dc%02d', cast(y // 224 as int), cast(x // 224 as int)) sample_id, cast(y // 224 as int) as "row", cast(x // 224 as int) col,
 round_even(count(*) filter (red <> -9999) / count(*), 4) valid_pct, round_even(coalesce(count(*) filter (fmask <> 255 and fmask & 14 <> 0) / nullif(count(*) filter (fmask <> 255), 0), 1), 4) cloud_pct
 from {_PATCHES} where y < 672 and x < 448 group by mgrs_tile, day, y // 224, x // 224 having count(*) filter (red <> -9999) / count(*) >= 0.5""")
def patch_rows(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    pixels = events.selectExpr(
        "'T36RUU' as mgrs_tile", "date_add(date'2023-08-01', cast(user_id % 3 as int)) as date", "'S30' as sensor", "cast((event_id * 7919) % 700 as int) as y", "cast((event_id * 104729) % 500 as int) as x",
        "cast(case when event_id % 13 = 0 then 255 else (event_id * 7) % 64 end as int) as fmask", "cast(case when event_id % 17 = 0 then -9999 else event_id % 3000 end as int) as red",
    )
    return grid.patch_rows(pixels, 700, 500, 300000.0, 3500040.0, 36).select("sample_id", "row", "col", "valid_pct", "cloud_pct")


def _layer_sql(v: str, hole: int, site: str) -> str:
    at = f"from (select id, least(floor(lat - 30), 6) iy, least(floor(lon - 22), 13) ix, lat - 30 - least(floor(lat - 30), 6) wy, lon - 22 - least(floor(lon - 22), 13) wx from {site}) t"
    c = f"(select id, iy + dy iy, ix + dx ix, (case dy when 1 then wy else 1 - wy end) * (case dx when 1 then wx else 1 - wx end) w {at}, (select unnest([0, 0, 1, 1]) dy, unnest([0, 1, 0, 1]) dx))"
    base = f"(select cast(l_partkey % 8 as int) iy, cast(l_orderkey % 15 as int) ix, avg({v}) v from lineitem where (l_partkey % 8 * 15 + l_orderkey % 15) % {hole} <> 5 group by 1, 2)"
    return f"(select id, round(case when count(b.v) = count(*) then sum(w * b.v) end, 5) v from {c} c left join {base} b on b.iy = c.iy and b.ix = c.ix where w > 0 group by 1)"


@query(f"select s.id, a.v ndvi, b.v t2m from {sql('site')} s join {_layer_sql('l_quantity', 31, sql('site'))} a on a.id = s.id join {_layer_sql('l_tax * 100', 43, sql('site'))} b on b.id = s.id")
def harmonised_stack(spark, d):
    y, x, axes = F.col("l_partkey") % 8, F.col("l_orderkey") % 15, (30, 1, 8, 22, 1, 15)
    line = spark.read.parquet(f"{d}/lineitem.parquet")

    def layer(v, hole: int) -> DataFrame:
        return line.where((y * 15 + x) % hole != 5).groupBy(y.cast("int").alias("lat_i"), x.cast("int").alias("lon_i")).agg(F.avg(v).alias("v"))

    sites = derived(spark, d, "site")
    stack = grid.harmonise(sites, {"ndvi": (layer(F.col("l_quantity"), 31), axes), "t2m": (layer(F.col("l_tax") * 100, 43), axes)})
    grid.require_aligned(stack, sites)
    path = _folder_of(spark, "stack")
    stack.select("id", F.round("ndvi", 5).alias("ndvi"), F.round("t2m", 5).alias("t2m")).write.parquet(path)
    return spark.read.parquet(path)
