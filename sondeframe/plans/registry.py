"""All registered queries of the library and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import geo, indices, names, sampling, utm
from sondeframe.operators import aggregates as A
from sondeframe.operators import catalog, dataset, grid, joins, labels, splits
from sondeframe.operators import windows as Wn
from sondeframe.plans.derived import derived, monthly, monthly_sql, sql
from sondeframe.streaming import fold

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def r6(c: Column | str, name: str) -> Column:
    return F.round(c, 6).alias(name)


_CLS = "case when spei < -1 and tmax_z > 2 and vhi < 35 then 3 when tmax_z > 2 then 2 when spei < -1 then 1 else 0 end"
_MASKED = f"case when spei is null or tmax_z is null or vhi is null then 255 else {_CLS} end"
_HIST = f"(select c.cls, count(p.cls) n from (select unnest([0,1,2,3]) cls) c left join (select {_MASKED} cls from {sql('pixel')}) p on p.cls = c.cls group by 1)"


def _classed(spark, d):
    return derived(spark, d, "pixel").withColumn("cls", indices.masked_class(F.col("spei"), F.col("tmax_z"), F.col("vhi")))


@query(f"""select cls, cast(n as bigint) n, round(n / sum(n) over (), 6) fraction, round(sum(case when cls = 3 then n else 0 end) over () / sum(n) over (), 6) compound_fraction,
 case when sum(case when cls = 3 then n else 0 end) over () / sum(n) over () between 0.005 and 0.08 then 'pass' else 'other' end verdict from {_HIST}""")
def class_prevalence_gate(spark, d):
    g = A.prevalence_gate(A.class_histogram(_classed(spark, d), F.col("cls")))
    return g.select("cls", "n", r6("fraction", "fraction"), r6("compound_fraction", "compound_fraction"), F.when(F.col("verdict") == "pass", "pass").otherwise("other").alias("verdict"))


@query(f"select {_CLS} cls, spei is null missing, cast(count(*) as bigint) n from {sql('pixel')} group by 1, 2")
def stress_classes(spark, d):
    cls = indices.classify(F.col("spei"), F.col("tmax_z"), F.col("vhi"))
    return derived(spark, d, "pixel").groupBy(cls.alias("cls"), F.col("spei").isNull().alias("missing")).agg(F.count("*").alias("n"))


_RATIO = "case when ({1}) > 0 then greatest(0.0, least(100.0, 100.0 * ({0}) / ({1}))) end"
_VCI, _TCI = _RATIO.format("ndvi - ndvi_lo", "ndvi_hi - ndvi_lo"), _RATIO.format("lst_hi - lst", "lst_hi - lst_lo")
_ZS, _ZT = "case when wb_std > 0 then (wb3 - wb_mean) / wb_std end", "case when t_std > 0 then (tmax - t_mean) / t_std end"


@query(f"""select cls, cast(count(*) as bigint) n, round(avg(spei), 4) spei, round(avg(tmax_z), 4) tmax_z, round(avg(vhi), 4) vhi from (
 select *, {_CLS} cls from (select {_ZS} spei, {_ZT} tmax_z, 0.5 * {_VCI} + 0.5 * {_TCI} vhi from {sql('raster')})) group by 1""")
def label_from_rasters(spark, d):
    df = derived(spark, d, "raster")
    cols = indices.label_columns(*[F.col(c) for c in df.columns[1:]])
    df = df.select(cols["spei3"].alias("spei"), cols["tmax_z"].alias("tmax_z"), cols["vhi"].alias("vhi"))
    cls = indices.classify(F.col("spei"), F.col("tmax_z"), F.col("vhi"))
    return df.groupBy(cls.alias("cls")).agg(F.count("*").alias("n"), *[F.round(F.avg(c), 4).alias(c) for c in df.columns])


_BOX = "lon between {0} and {2} and lat between {1} and {3}"


@query(f"""select id, {_BOX.format(*C.ROI)} in_roi, case when {_BOX.format(*C.OOD)} then 'ood_nw_africa' when {_BOX.format(*C.DELTA)} then 'delta' when {_BOX.format(*C.N_COAST)} then 'n_coast'
 when {_BOX.format(*C.ROI)} then 'em_shelf' end region, case when {_BOX.format(*C.DELTA)} then 'delta' when {_BOX.format(*C.N_COAST)} then 'n_coast' else 'em_shelf' end patch_region from {sql('site')}""")
def regions(spark, d):
    lon, lat = F.col("lon"), F.col("lat")
    return derived(spark, d, "site").select("id", geo.in_box(lon, lat, C.ROI).alias("in_roi"), geo.region(lon, lat, strict=False).alias("region"), geo.patch_region(lon, lat).alias("patch_region"))


@query(f"""select k, substr(id, 5, 3) sensor, substr(id, 9, 6) tile, day, cast(dayofyear(day) as int) doy, id like '%.T36RUU.%' same_tile, cast(32636 as int) epsg from {sql('scene')}""")
def scene_names(spark, d):
    s = F.col("id")
    return derived(spark, d, "scene").select("k", names.sensor_of(s).alias("sensor"), names.tile_of(s).alias("tile"), names.scene_date(s).alias("day"),
        F.dayofyear(names.scene_date(s)).alias("doy"), (names.part(s, 2) == "T36RUU").alias("same_tile"), geo.epsg_of_tile(names.tile_of(s)).alias("epsg"))


@query(f"""select k, 'T36RUU_' || cast(day as varchar) || '_r' || lpad(cast(k % 16 as varchar), 2, '0') || 'c' || lpad(cast(k % 13 as varchar), 2, '0') sample_id,
 'tiles_T36RUU_' || cast(year(day) as varchar) || '.zarr::image' image_path, 'precip.' || cast(year(day) as varchar) || '.' || lpad(cast(month(day) as varchar), 2, '0') || '.nc' month_file,
 cast(k % 40 - 10 as varchar) || '_' || cast(k % 7 + 30 as varchar) cell_key, cast(k % 40 - 10 as int) cell_lon from {sql('scene')}""")
def made_names(spark, d):
    key = names.cell_key(F.col("k") % 40 - 10, F.col("k") % 7 + 30)
    return derived(spark, d, "scene").select("k", names.sample_id(F.lit("T36RUU"), F.col("day"), F.col("k") % 16, F.col("k") % 13).alias("sample_id"),
        names.image_path(F.lit("T36RUU"), F.col("day")).alias("image_path"), names.month_file(F.year("day"), F.month("day")).alias("month_file"), key.alias("cell_key"),
        names.parse_cell_key(key)[0].alias("cell_lon"))


@query(f"""select k, case when k % 5 = 0 then null else 'u/B04' end red, case when k % 5 = 0 then null when substr(id, 5, 3) = 'S30' then 'u/B8A' else 'u/B05' end nir from {sql('scene')}""")
def band_links(spark, d):
    codes = ["B02", "B03", "B04", "B05", "B06", "B07", "B8A", "B11", "B12"]
    have = F.array(*[F.lit(c) for c in codes], F.when(F.col("k") % 5 != 0, "Fmask").otherwise("other"))
    assets = F.map_from_arrays(have, F.transform(have, lambda c: F.concat(F.lit("u/"), c)))
    links = names.band_hrefs(assets, names.sensor_of(F.col("id")), catalog.BANDS)
    return derived(spark, d, "scene").select("k", links["red"].alias("red"), links["nir"].alias("nir"))


@query("""select p_partkey, upper(p_name) like 'MOD%' terra, case when p_size % 2 = 0 then p_size between -2000 and 10000 else p_size > 0 end valid,
 case p_size % 3 when 0 then 'ndvi' when 1 then '250m_NDVI' end asset from part""")
def product_rules(spark, d):
    keys = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("x_NDVI"), F.lit("ndvi"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("250m_NDVI"), F.lit("b_ndvi"))).otherwise(F.array(F.lit("evi")))
    product = F.when(F.col("p_size") % 2 == 0, "MOD13Q1").otherwise("MOD11A2")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", names.is_terra(F.col("p_name")).alias("terra"), indices.valid_product(product, F.col("p_size")).alias("valid"), names.pick_asset(keys, "NDVI").alias("asset"))


@query("""select y as year, cast(count(*) as bigint) n, cast(max(d) as date) last_day, case when y + 22 between 2017 and 2022 then 'train' when y + 22 = 2023 then 'test' when y + 22 = 2024 then 'ood_time' else 'none' end part
 from (select distinct cast(year(o_orderdate) as int) y from orders), lateral (select unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), interval 16 day)) d) where dayofyear(d) <= 365 group by 1""")
def composite_dates(spark, d):
    """Composite starts of every year in the table, with the split that the year 22 later belongs to."""
    y = spark.read.parquet(f"{d}/orders.parquet").select(F.year("o_orderdate").alias("year"))
    starts = _composite_starts(y, "d").where(F.dayofyear("d") <= 365).groupBy(F.year("d").alias("year"))
    return starts.agg(F.count("*").alias("n"), F.max("d").alias("last_day")).withColumn("part", splits.temporal_split(F.col("year") + 22))


@query("""select cast(year(o_orderdate) as int) "year", cast(month(o_orderdate) as int) "month", cast(min(day(last_day(o_orderdate))) as int) n_days, cast(list_sort(list(distinct cast(day(o_orderdate) as int))) as varchar) "days" from orders group by 1, 2""")
def days_by_month(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    g = o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    days = F.sort_array(F.collect_set(F.dayofmonth("o_orderdate")))  # at most 31
    return g.agg(F.min(F.dayofmonth(F.last_day("o_orderdate"))).alias("n_days"), F.concat(F.lit("["), F.array_join(days, ", "), F.lit("]")).alias("days"))


@query(f"""select cls_key, round(min(case when vhi between 1 and 95 then vhi end), 6) v_min, round(max(case when vhi between 1 and 95 then vhi end), 6) v_max from {sql('pixel')} group by 1""")
def min_max_climatology(spark, d):
    return A.min_max(derived(spark, d, "pixel"), ["cls_key"], F.when(F.col("vhi").between(1, 95), F.col("vhi")))


@query(f"""select cell, cast(ts as date) as "day", round(max(t2m - 273.15), 6) tmax, round(min(t2m - 273.15), 6) tmin from {sql('hourly')} group by 1, 2""")
def hourly_to_daily(spark, d):
    return A.hourly_to_daily(derived(spark, d, "hourly"), ["cell"], "ts", "t2m").select("cell", "day", r6("tmax", "tmax"), r6("tmin", "tmin"))


@query(f"""select cell, cast(ts as date) as "day", round(avg(t2m), 6) t2m, round(max(t2m), 6) tmax, round(min(t2m), 6) tmin, round(avg(swvl1), 5) swvl1, round(sum(e), 5) e, round(sum(tp), 5) tp from {sql('hourly')} group by 1, 2""")
def daily_channels(spark, d):
    df = A.daily_channels(derived(spark, d, "hourly"), ["cell"], "ts")
    return df.select("cell", "day", *[F.round(c, 6 if c.startswith("t") and c != "tp" else 5).alias(c) for c in df.columns[2:]])


@query(f"""with m as (select cell, cast(dayofyear(dd) as int) doy, sum(tmax) s1, sum(tmax * tmax) s2, count(*) n from (select cell, cast(ts as date) dd, max(t2m - 273.15) tmax from {sql('hourly')} group by 1, 2) group by 1, 2),
 w as (select cell, cast((doy - 1 + k + 366) % 366 + 1 as int) doy, s1, s2, n from m, (select unnest(generate_series(-15, 15)) k)),
 p as (select cell, doy, sum(n) n, sum(s1) / sum(n) mean, sum(s2) / sum(n) sq from w group by 1, 2)
 select cell, doy, cast(n as bigint) n, round(mean, 3) mean, round(sqrt(greatest(sq - mean * mean, 0)), 2) std from p""")
def circular_doy_stats(spark, d):
    daily = A.hourly_to_daily(derived(spark, d, "hourly"), ["cell"], "ts", "t2m")
    out = Wn.circular_doy(A.doy_moments(daily, ["cell"], F.dayofyear("day"), F.col("tmax")), ["cell"])
    return out.select("cell", "doy", "n", F.round("mean", 3).alias("mean"), F.round("std", 2).alias("std"))


_BAL = f"(select a.cell, a.ym, precip - pet wb from {monthly_sql('precip')} a join {monthly_sql('pet')} b using (cell, ym))"


@query(f"""with r as (select cell, ym, case when count(wb) over w = 3 then sum(wb) over w end rolled from {_BAL} window w as (partition by cell order by ym rows between 2 preceding and current row))
 select cell, cast(ym % 100 as int) as "month", round(avg(rolled), 5) wb_mean, round(stddev_pop(rolled), 5) wb_std from r group by 1, 2""")
def water_balance_stats(spark, d):
    out = Wn.water_balance(monthly(spark, d, "precip"), monthly(spark, d, "pet"), ["cell"])
    return out.select("cell", "month", F.round("wb_mean", 5).alias("wb_mean"), F.round("wb_std", 5).alias("wb_std"))


@query(f"""with days as (select distinct cast(date_trunc('month', o_orderdate) as date) + 14 as dd from orders), k as (select dd, cast(year(dd - to_months(m)) * 100 + month(dd - to_months(m)) as int) ym from days, (select unnest([0, 1, 2]) m))
 select cell, dd as "day", round(case when count(wb) = 3 then sum(wb) end, 5) wb3 from k join {_BAL} using (ym) group by 1, 2""")
def three_month_balance(spark, d):
    days = spark.read.parquet(f"{d}/orders.parquet").select(F.date_add(F.trunc("o_orderdate", "month"), 14).alias("day")).distinct()
    bal = monthly(spark, d, "precip").join(monthly(spark, d, "pet"), ["cell", "ym"]).withColumn("wb", F.col("precip") - F.col("pet"))
    return Wn.balance_on(days, bal, ["cell"]).select("cell", "day", F.round("wb3", 5).alias("wb3"))


@query(f"""select ym, 'precip' side from (select distinct ym from {monthly_sql('precip')} except select distinct ym from {monthly_sql('pet')}) union all
 select ym, 'pet' from (select distinct ym from {monthly_sql('pet')} except select distinct ym from {monthly_sql('precip')})""")
def unmatched_months(spark, d):
    a, b = monthly(spark, d, "precip"), monthly(spark, d, "pet")
    bad = joins.months_must_match(a, b)
    return bad.join(a.select("ym").distinct().withColumn("in_a", F.lit(True)), "ym", "left").select("ym", F.when(F.col("in_a"), "precip").otherwise("pet").alias("side"))


@query(f"""with h as {_HIST}, t as (select sum(n) total, count(*) filter (n > 0) present, median(n) filter (n > 0) middle from h)
 select cls, cast(n as bigint) n, round(case when n > 0 then middle / n else 0 end, 6) median_freq, round(case when n > 0 then total / (present * n) else 0 end, 6) inverse from h, t""")
def class_weights(spark, d):
    h = A.class_histogram(_classed(spark, d), F.col("cls"))
    a = A.class_weights(h).withColumnRenamed("weight", "m")
    b = A.class_weights(h, "inverse").select("cls", F.col("weight").alias("i"))
    return a.join(b, "cls").select("cls", "n", r6("m", "median_freq"), r6("i", "inverse"))


_LONG = "(select cell, cast(ts as date) dd, unnest(['t2m', 'swvl1', 'tp', 'e']) channel, unnest([t2m, swvl1, tp, e]) \"value\" from {0})".format(sql("hourly"))


def _long(spark, d):
    h = derived(spark, d, "hourly").withColumn("day", F.to_date("ts"))
    return h.unpivot(["cell", "day"], ["t2m", "swvl1", "tp", "e"], "channel", "value")


@query(f"""select c.channel, round(coalesce(m, 0), 6) mean, round(case when s > 0 then s else 1 end, 6) std from (select unnest(['t2m','tmax','tmin','precip','swvl1','e','tp']) channel) c
 left join (select channel, avg("value") m, stddev_pop("value") s from {_LONG} where cell < 10 group by 1) using (channel)""")
def train_channel_stats(spark, d):
    return A.channel_stats(_long(spark, d).where("cell < 10")).select("channel", r6("mean", "mean"), r6("std", "std"))


@query(f"""with s as (select channel, avg("value") m, stddev_pop("value") s from {_LONG} where cell < 10 group by 1)
 select cell, channel, cast(count(*) as bigint) n, round(avg(("value" - m) / s), 4) z from {_LONG} join s using (channel) group by 1, 2""")
def normalised_channels(spark, d):
    long = _long(spark, d)
    z = A.normalise(long, A.channel_stats(long.where("cell < 10")))
    return z.groupBy("cell", "channel").agg(F.count("*").alias("n"), F.round(F.avg("z"), 4).alias("z"))


_SHA = "cast(('0x' || substr(sha256('20260519:' || {0}), 1, 13)) as bigint) / 4503599627370496.0"
_PATCH = f"""(select *, case cls when 0 then 0.015 when 1 then 0.04 when 2 then 0.4 when 3 then 1.0 else 0 end p, cast(tile as varchar) || '_' || cast("day" as varchar) || '_r' || lpad(cast("row" as varchar), 2, '0') || 'c' || lpad(cast(col as varchar), 2, '0') sample_id
 from (select tile, "day", "row", col, max(cls) filter (cls <> 255) cls from {sql('label')} group by 1, 2, 3, 4))"""
_KEPT = f"(select *, cls is not null and (p >= 1 or (p > 0 and {_SHA.format('sample_id')} < p)) kept from {_PATCH})"


def _patches(spark, d):
    sid = names.sample_id(F.col("tile").cast("string"), F.col("day"), F.col("row"), F.col("col"))
    return dataset.select_patches(derived(spark, d, "label"), ["tile", "day", "row", "col"], sid)


@query(f"select sample_id, cls, kept from {_KEPT}")
def selected_patches(spark, d):
    return _patches(spark, d).select("sample_id", "cls", "kept")


@query(f"""select "day", cast(count(*) as bigint) n_patches, cast(count(*) filter (cls is null) as bigint) n_nodata, cast(count(*) filter (kept) as bigint) n_kept,
 round(coalesce(count(*) filter (kept and cls = 3) / nullif(count(*) filter (kept), 0), 0), 6) compound_fraction, round(count(*) filter (kept) * 8 * 770 / 1e6, 6) gb from {_KEPT} group by rollup ("day")""")
def selection_report(spark, d):
    r = dataset.selection_report(_patches(spark, d), ["day"])
    return r.select("day", "n_patches", "n_nodata", "n_kept", r6("compound_fraction", "compound_fraction"), r6("gb", "gb"))


@query(f"""select tile, "day", cast(count(*) as bigint) n, cast(sum("row" * 100 + col + cls) as bigint) digest from {_KEPT} where kept group by 1, 2""")
def keep_list(spark, d):
    k = dataset.keep_list(_patches(spark, d), ["tile", "day"])
    digest = F.aggregate("patches", F.lit(0).cast("bigint"), lambda a, p: a + p["row"] * 100 + p["col"] + p["cls"])
    return k.select("tile", "day", F.size("patches").cast("bigint").alias("n"), digest.alias("digest"))


@query(f"select o_orderkey, round({_SHA.format('cast(o_orderkey as varchar)')}, 9) u, {_SHA.format('cast(o_orderkey as varchar)')} < 0.25 kept from orders")
def hash_sample(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", F.round(sampling.unit_hash(F.col("o_orderkey")), 9).alias("u"), sampling.keep(F.col("o_orderkey"), F.lit(0.25)).alias("kept"))


@query()
def hash_sample_exact(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", sampling.unit_hash_exact()(F.col("o_orderkey").cast("string")).alias("u"))


@query(f"""with y as (select "year", {_MASKED} cls from {sql('pixel')}) select "year", cls, cast(count(*) as bigint) n, round(count(*) / sum(count(*)) over (partition by "year" is null, "year"), 6) fraction
 from y where cls <> 255 group by grouping sets (("year", cls), (cls))""")
def gate_pool(spark, d):
    p = _classed(spark, d).where(F.col("cls") != C.NODATA)
    g = p.groupingSets([["year", "cls"], ["cls"]], "year", "cls").agg(F.count("*").alias("n"))
    total = p.groupingSets([["year"], []], "year").agg(F.count("*").alias("t"))  # one row a year
    return g.join(F.broadcast(total), g["year"].eqNullSafe(total["year"])).select(g["year"], "cls", "n", r6(F.col("n") / F.col("t"), "fraction"))


@query(f"""select 'split' dimension, split "value", cast(count(*) as bigint) n from {sql('indexed')} group by 2 union all select 'region', region, count(*) from {sql('indexed')} group by 2
 union all select 'year', cast(year("day") as varchar), count(*) from {sql('indexed')} group by 2""")
def split_region_year(spark, d):
    return A.independent_counts(derived(spark, d, "indexed").withColumn("year", F.year("day")), ["split", "region", "year"])


@query(f"""select pixel % 50 cell, max(ndvi) ndvi from {sql('raster')} group by 1""")
def mosaic(spark, d):
    return A.mosaic_max(derived(spark, d, "raster").withColumn("cell", F.col("pixel") % 50), ["cell"], "ndvi")


_COMP = "(select cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), interval 16 day)) as date) cd from (select distinct cast(year(o_orderdate) as int) y from orders where o_orderdate is not null and year(o_orderdate) % 2 = 0))"


@query(f"""select o_orderkey, cast(coalesce((select max(cd) from {_COMP} where cd <= cast(o_orderdate as date)), (select min(cd) from {_COMP})) as date) label_date from orders""")
def as_of_label(spark, d):
    """The label active at each order's day: composites of every other year, so days before and between count too."""
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    dates = _composite_starts(o.select(F.year("day").alias("year")).where("year % 2 = 0"), "day")
    return joins.as_of_small(o, dates, "day", "label_date").select("o_orderkey", "label_date")


@query("""with r as (select distinct user_id % 16 k, cast(ts as date) rd from events where event_id % 9 = 0), l as (select event_id, user_id % 16 k, cast(ts as date) ld from events)
 select event_id, coalesce((select max(rd) from r where r.k = l.k and rd <= ld), (select min(rd) from r where r.k = l.k)) match from l""")
def as_of_keyed(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", (F.col("user_id") % 16).alias("k"), F.to_date("ts").alias("day"))
    return joins.as_of(e, e.where("event_id % 9 = 0").select("k", "day").distinct(), ["k"], "day", "match").select("event_id", "match")


@query("""with r as (select distinct cast(o_orderdate as date) rd, 'f' || cast(o_orderdate as varchar) path from orders where o_orderkey % 97 = 0), l as (select distinct cast(o_orderdate as date) ld from orders)
 select ld as "day", arg_min(path, abs(rd - ld) * 1000000 + (rd - date '1990-01-01')) path from l, r group by 1""")
def nearest_composite(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    one = F.lit(1).alias("k")
    r = o.where("o_orderkey % 97 = 0").select(one, F.to_date("o_orderdate").alias("day"), F.concat(F.lit("f"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("path")).distinct()
    return joins.nearest_date(o.select(one, F.to_date("o_orderdate").alias("day")).distinct(), r, ["k"], "day", "path").select("day", "path")


@query(f"""select id, cast(greatest(0, least(69, round_even((lat - 30) / 0.1, 0))) as int) lat_i, cast(greatest(0, least(139, round_even((lon - 22) / 0.1, 0))) as int) lon_i from {sql('site')}""")
def nearest_grid_cell(spark, d):
    return derived(spark, d, "site").select("id", joins.grid_index(F.col("lat"), 30, 0.1, 70).alias("lat_i"), joins.grid_index(F.col("lon"), 22, 0.1, 140).alias("lon_i"))


_BOXES = "(select s_suppkey bid, 22 + s_suppkey % 13 w, 30 + s_suppkey % 6 s, 22 + s_suppkey % 13 + 0.75 e, 30 + s_suppkey % 6 + 0.5 n from supplier)"


def _boxes(spark, d):
    k = F.col("s_suppkey")
    return spark.read.parquet(f"{d}/supplier.parquet").select(k.alias("bid"), (22 + k % 13).cast("double").alias("w"), (30 + k % 6).cast("double").alias("s"), (22 + k % 13 + 0.75).alias("e"), (30 + k % 6 + 0.5).alias("n"))


@query(f"select bid, id from {_BOXES} join {sql('site')} on lon between w and e and lat between s and n")
def points_in_boxes(spark, d):
    return joins.boxes_to_points(_boxes(spark, d), derived(spark, d, "site"), "bid").select("bid", "id")


@query(f"select bid from {_BOXES} b where exists (select 1 from {sql('site')} where lon between w and e and lat between s and n)")
def boxes_with_points(spark, d):
    return joins.boxes_to_points(_boxes(spark, d), derived(spark, d, "site"), "bid").select("bid").distinct()


_HAV = "2 * 6371.0088 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"


@query(f"""select a.id near_id, b.id far_id, round({_HAV}, 5) km from {sql('site')} a join {sql('site')} b on a.id % 2 = 0 and b.id % 2 = 1 and {_HAV} < 25""")
def distance_pairs(spark, d):
    s = derived(spark, d, "site")
    return joins.pairs_within(s.where("id % 2 = 0"), s.where("id % 2 = 1")).select("near_id", "far_id", F.round("km", 5).alias("km"))


_CELLS = splits.assign_cells(splits.box_cells(C.ROI), splits.box_cells(C.OOD))
_CELL_SQL = "(select * from (values " + ", ".join(f"({x}, {y}, '{s}')" for (x, y), s in _CELLS.items()) + ") v(cx, cy, split))"
_NEAREST = "least(cx + 1.0, greatest(cx, lon))", "least(cy + 1.0, greatest(cy, lat))"
_CKM = f"2 * 6371.0088 * asin(least(1, sqrt(pow(sin(radians({_NEAREST[1]} - lat) / 2), 2) + cos(radians(lat)) * cos(radians({_NEAREST[1]})) * pow(sin(radians({_NEAREST[0]} - lon) / 2), 2))))"


@query(f"""select p.id, case when b.split is null then 'none' when exists (select 1 from {_CELL_SQL} c where abs(cx - floor(lon)) <= 1 and abs(cy - floor(lat)) <= 1 and c.split <> b.split and {_CKM} < 25) then 'buffer' else b.split end split
 from {sql('site')} p left join {_CELL_SQL} b on b.cx = floor(lon) and b.cy = floor(lat)""")
def spatial_split(spark, d):
    return splits.split_points(derived(spark, d, "site"), splits.cells_frame(spark, _CELLS))


@query()
def split_cells(spark, d):
    """The seeded split of the whole-degree cells that hold sites, with their number of sites."""
    x, y = geo.cell(F.col("lon"), F.col("lat"))
    held = derived(spark, d, "site").groupBy(x.alias("cell_lon"), y.alias("cell_lat")).agg(F.count("*").alias("n"))
    cells = [(r["cell_lon"], r["cell_lat"]) for r in held.select("cell_lon", "cell_lat").collect()]  # 64,800 on the whole globe
    return splits.cells_frame(spark, splits.assign_cells(cells)).join(held, ["cell_lon", "cell_lat"])


def _composite_starts(years: DataFrame, name: str) -> DataFrame:
    """Each sixteenth day from the first of January, of every ``year`` in the table."""
    y = years.where("year is not null").distinct()
    return y.select(F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31)), F.expr("interval 16 days"))).alias(name))


_ALL_STARTS = f"(select cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), interval 16 day)) as date) w from (select distinct cast(year(day) as int) y from {sql('scene')} where day is not null))"


@query(f"""with s as (select * from {sql('scene')}), first as (select k, min(w) w from s join {_ALL_STARTS} on w <= day and day < w + 16 group by 1)
 select w as "window", id, day as "day" from (select w, s.*, row_number() over (partition by w order by coalesce(cloud, 100), day, id) rn, substr(id, 5, 3) se from s join first using (k)) where rn = 1 and se = 'S30'""")
def one_scene_per_window_all_years(spark, d):
    s = derived(spark, d, "scene")
    links = F.when(names.sensor_of(F.col("id")) == "S30", F.lit("x"))
    return catalog.one_per_window(s, _composite_starts(s.select(F.year("day").alias("year")), "start"), links).select("window", "id", "day")


@query(f"""select day as "day", min(id) id from {sql('scene')} where substr(id, 5, 3) = 'S30' group by 1""")
def first_scene_per_date(spark, d):
    return catalog.first_per_date(derived(spark, d, "scene"), F.when(names.sensor_of(F.col("id")) == "S30", F.lit("x"))).select("day", "id")


@query(f"""select day as "day", max(id) || '.B04.tif' path, substr(max(id), 5, 3) sensor from {sql('scene')} group by 1""")
def disk_scenes(spark, d):
    return catalog.disk_scenes(derived(spark, d, "scene").select(F.concat("id", F.lit(".B04.tif")).alias("path"))).select("day", "path", "sensor")


@query(f"""select k, day as "day", round(cloud, 6) cloud from {sql('scene')} where day between date '1996-02-01' and date '1997-03-01' and cloud < 50""")
def catalog_search(spark, d):
    return catalog.search(derived(spark, d, "scene"), "T36RUU", "1996-02-01", "1997-03-01").select("k", "day", r6("cloud", "cloud"))


@query("""select t.tile, y.y as "year" from (select distinct s_suppkey % 11 tile from supplier) t, (select distinct cast(year(o_orderdate) as int) y from orders) y
 where not exists (select 1 from customer c where c_custkey % 11 = t.tile and 1995 + c_custkey % 3 = y.y and c_custkey < 9) and y.y in (select cast(year(l_shipdate) as int) from lineitem)""")
def work_left(spark, d):
    t = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    tiles = t("supplier").select((F.col("s_suppkey") % 11).alias("tile")).distinct()
    years = t("orders").select(F.year("o_orderdate").alias("year")).distinct()
    done = t("customer").where("c_custkey < 9").select((F.col("c_custkey") % 11).alias("tile"), (1995 + F.col("c_custkey") % 3).cast("int").alias("year"))
    return joins.work_left(tiles, years, done, t("lineitem").select(F.year("l_shipdate").alias("year")))


_DAILY = f"(select cell, cast(ts as date) dd, avg(t2m) t2m, max(t2m) tmax, min(t2m) tmin, avg(swvl1) swvl1, sum(e) e, sum(tp) tp from {sql('hourly')} group by 1, 2)"


@query(f"""with daily as materialized {_DAILY}, s as (select cast(c_custkey as varchar) sample_id, cast(c_custkey % 16 as int) cell, unnest(generate_series(date '2024-01-20' + cast(c_custkey % 10 as int) - 89, date '2024-01-20' + cast(c_custkey % 10 as int), interval 1 day)) dd from customer)
 select sample_id, round((count(t2m) + count(tmax) + count(tmin) + count(swvl1) + count(e) + count(tp)) / 540, 6) coverage, cast(count(*) as bigint) "days" from s left join daily on daily.cell = s.cell and daily.dd = s.dd group by 1""")
def meteo_coverage_all_samples(spark, d):
    s = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("string").alias("sample_id"), (F.col("c_custkey") % 16).cast("int").alias("cell"),
        F.expr("date_add(date'2024-01-20', cast(c_custkey % 10 as int))").alias("end"))
    series = dataset.meteo_series(s, A.daily_channels(derived(spark, d, "hourly"), ["cell"], "ts"), ["cell"])
    n = series.groupBy("sample_id").agg(F.count("*").alias("days"))
    return dataset.coverage(series, ["t2m", "tmax", "tmin", "swvl1", "e", "tp"]).join(n, "sample_id").select("sample_id", r6("coverage", "coverage"), "days")


@query(f"""select patch, round(coalesce(count(*) filter (red <> -9999) / count(*), 0), 6) valid_pct, round(coalesce(count(*) filter (fmask <> 255 and fmask & 14 <> 0) / nullif(count(*) filter (fmask <> 255), 0), 1), 6) cloud_pct
 from {sql('fmask')} group by 1 having count(*) filter (red <> -9999) / count(*) >= 0.5""")
def patch_quality(spark, d):
    q = grid.patch_quality(derived(spark, d, "fmask").withColumn("y", F.lit(0)).withColumn("x", F.lit(0)), ["patch"])
    return q.select("patch", r6("valid_pct", "valid_pct"), r6("cloud_pct", "cloud_pct"))


_BASE = "(select cast(l_partkey % 8 as int) iy, cast(l_orderkey % 15 as int) ix, avg(l_quantity) v from lineitem where (l_partkey % 8 * 15 + l_orderkey % 15) % 31 <> 5 group by 1, 2)"
_BIL = "from (select id, least(floor(lat - 30), 6) iy, least(floor(lon - 22), 13) ix, lat - 30 - least(floor(lat - 30), 6) wy, lon - 22 - least(floor(lon - 22), 13) wx from {0}) t".format(sql("site"))


@query(f"""with c as (select id, iy + dy iy, ix + dx ix, (case dy when 1 then wy else 1 - wy end) * (case dx when 1 then wx else 1 - wx end) w {_BIL}, (select unnest([0, 0, 1, 1]) dy, unnest([0, 1, 0, 1]) dx))
 select id, round(case when count(b.v) = count(*) then sum(w * b.v) end, 5) v from c left join {_BASE} b on b.iy = c.iy and b.ix = c.ix where w > 0 group by 1""")
def bilinear_regrid(spark, d):
    lat_i, lon_i = F.col("l_partkey") % 8, F.col("l_orderkey") % 15
    line = spark.read.parquet(f"{d}/lineitem.parquet").where((lat_i * 15 + lon_i) % 31 != 5)
    base = line.groupBy(lat_i.cast("int").alias("lat_i"), lon_i.cast("int").alias("lon_i")).agg(F.avg("l_quantity").alias("v"))
    return grid.bilinear(base, derived(spark, d, "site"), 30, 1, 8, 22, 1, 15).select("id", F.round("v", 5).alias("v"))


@query("""select s_suppkey id, cast(k // (w // 224) as int) as "row", cast(k % (w // 224) as int) col from (select s_suppkey, 1000 + s_suppkey % 900 h, 1500 + s_suppkey * 7 % 1100 w from supplier), lateral (select unnest(range((h // 224) * (w // 224))) k)""")
def patch_origins(spark, d):
    k = F.col("s_suppkey")
    sizes = spark.read.parquet(f"{d}/supplier.parquet").select(k.alias("id"), (1000 + k % 900).alias("height"), (1500 + k * 7 % 1100).alias("width"))
    return grid.patch_origins(sizes)


@query(f"""select bid id, cast(k // 16 as int) as "row", cast(k % 16 as int) col, round(w + (k % 16) * (e - w) / 16, 6) cw, round(s + (k // 16) * (n - s) / 16, 6) cs from {_BOXES}, (select unnest(range(256)) k)""")
def box_cells(spark, d):
    return grid.box_cells(_boxes(spark, d).withColumnRenamed("bid", "id")).select("id", "row", "col", r6("cw", "cw"), r6("cs", "cs"))


@query("""select b.id, cast(x as int) cell_lon, cast(y as int) cell_lat from (select s_suppkey id, 22 + s_suppkey % 13 / 2.0 w, 30 + s_suppkey % 7 / 2.0 s, 25 + s_suppkey % 11 / 3.0 e, 33 + s_suppkey % 5 / 4.0 n from supplier) b,
 lateral (select unnest(generate_series(cast(ceil(w) as bigint), cast(floor(e) as bigint) - 1)) x), lateral (select unnest(generate_series(cast(ceil(s) as bigint), cast(floor(n) as bigint) - 1)) y)""")
def whole_cells(spark, d):
    k = F.col("s_suppkey")
    edges = {"w": 22 + k % 13 / 2.0, "s": 30 + k % 7 / 2.0, "e": 25 + k % 11 / 3.0, "n": 33 + k % 5 / 4.0}
    boxes = spark.read.parquet(f"{d}/supplier.parquet").select(k.alias("id"), *[v.alias(c) for c, v in edges.items()])
    return grid.whole_cells(boxes)


@query()
def utm_round_trip(spark, d):
    s = derived(spark, d, "site")
    z = utm.zone_of(F.col("lon"))
    e, n = utm.forward(F.col("lon"), F.col("lat"), z)
    s = s.select("id", "lon", "lat", z.alias("zone"), e.alias("east"), n.alias("north"))
    lon, lat = utm.inverse(F.col("east"), F.col("north"), F.col("zone"))
    return s.withColumn("off", F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat"))).withColumn("tile", utm.mgrs_square(F.col("lon"), F.col("lat")))


@query()
def roi_tiles(spark, d):
    """100 km squares that each supplier's box meets, with the squares' own boxes and whether they reach the OOD area."""
    found = grid.squares_in_boxes(_boxes(spark, d).withColumnRenamed("bid", "id"))
    ood = (F.col("w") <= C.OOD[2]) & (F.col("e") >= C.OOD[0]) & (F.col("s") <= C.OOD[3]) & (F.col("n") >= C.OOD[1])
    return found.withColumn("is_ood", ood)


@query(f"select sample_id from {sql('indexed')} where split in ('train', 'val', 'test', 'ood')")
def member_rows(spark, d):
    return dataset.members(derived(spark, d, "indexed"))[0].select("sample_id")


@query(f"select split, cast(count(*) as bigint) n from {sql('indexed')} where split in ('buffer', 'none') group by 1")
def excluded_rows(spark, d):
    return dataset.members(derived(spark, d, "indexed"))[1]


@query(f"""select sample_id, concat_ws(',', case when center_lat > 90 then 'center_lat' end, case when cloud_pct > 1 then 'cloud_pct' end, case when region = 'sea' then 'region' end) problems from {sql('indexed')} where center_lat > 90 or region = 'sea' or cloud_pct > 1""")
def schema_violations(spark, d):
    return dataset.violations(derived(spark, d, "indexed")).select("sample_id", F.array_join("problems", ",").alias("problems"))


@query(f"""select sample_id from {sql('indexed')} where cast(sample_id as bigint) % 3 <> 0""")
def appended_rows(spark, d):
    s = derived(spark, d, "indexed")
    return dataset.new_rows(s.unionByName(s.where("region = 'delta'")), s.where("cast(sample_id as bigint) % 3 = 0")).select("sample_id")


@query(f"""select cast(day as date) as "day" from {sql('scene')} where k % 2 = 0 intersect select day from {sql('scene')} where k % 2 = 1""")
def shared_dates(spark, d):
    s = derived(spark, d, "scene")
    return s.where("k % 2 = 0").select("day").intersect(s.where("k % 2 = 1").select("day"))


@query(f"""select cast(count(*) as bigint) n, cast(count(distinct sample_id) as bigint) ids from (select sample_id from {sql('indexed')} union all select sample_id from {sql('indexed')} where region = 'delta')""")
def consolidated(spark, d):
    s = derived(spark, d, "indexed")
    return dataset.consolidate([s, s.where("region = 'delta'").drop("valid_pct")]).agg(F.count("*").alias("n"), F.count_distinct("sample_id").alias("ids"))


_PHI, _TURN = "radians(30.0 + cell * 0.4)", "2 * pi() * dayofyear(dd) / 365"
_TILT = f"(0.409 * sin({_TURN} - 1.39))"
_SUN = f"acos(greatest(-1, least(1, -tan({_PHI}) * tan({_TILT}))))"
_RA = f"24 * 60 / pi() * 0.0820 * (1 + 0.033 * cos({_TURN})) * ({_SUN} * sin({_PHI}) * sin({_TILT}) + cos({_PHI}) * cos({_TILT}) * sin({_SUN}))"


@query(f"""select cell, cast(year(dd) * 100 + month(dd) as int) ym, round(sum(0.0023 * 0.408 * ({_RA}) * ((tmax + tmin) / 2 + 17.8) * sqrt(greatest(tmax - tmin, 0))), 4) pet
 from (select cell, cast(ts as date) dd, max(t2m - 273.15) tmax, min(t2m - 273.15) tmin from {sql('hourly')} group by 1, 2) group by 1, 2""")
def monthly_pet(spark, d):
    daily = A.hourly_to_daily(derived(spark, d, "hourly"), ["cell"], "ts", "t2m")
    pet = indices.hargreaves(F.col("tmax"), F.col("tmin"), indices.extraterrestrial(30.0 + F.col("cell") * 0.4, F.dayofyear("day")))
    keyed = daily.withColumn("ym", (F.year("day") * 100 + F.month("day")).cast("int"))
    return A.monthly_sum(keyed, ["cell", "ym"], pet).select("cell", "ym", F.round("total", 4).alias("pet"))


@query(f"""select cell, cast(dayofyear(dd) as int) doy, cast(count(*) as bigint) n, round(sum(tmax), 5) s1, round(stddev_pop(tmax), 5) std from (select cell, cast(ts as date) dd, max(t2m - 273.15) tmax from {sql('hourly')} group by 1, 2) group by 1, 2""")
def streamed_doy_fold(spark, d):
    daily = A.hourly_to_daily(derived(spark, d, "hourly"), ["cell"], "ts", "t2m").withColumn("doy", F.dayofyear("day"))
    out = fold.fold_moments(daily.select("cell", "doy", F.col("tmax").alias("value")), ["cell", "doy"])
    return out.select("cell", "doy", "n", F.round(F.col("mean") * F.col("n"), 5).alias("s1"), F.round(F.sqrt(F.col("m2") / F.col("n")), 5).alias("std"))


_TMAX = "(select cast(o_custkey % 20 as int) cell, cast(o_orderdate as date) dd, avg(20 + o_totalprice % 25) tmax from orders group by 1, 2)"
_VEG = "(select cast(l_suppkey % 20 as int) cell, cast(date_trunc('month', l_shipdate) as date) dd, avg(l_quantity / 50) ndvi, avg(290 + l_discount * 300) lst from lineitem group by 1, 2)"


_DATES_ALL = "select cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), interval 16 day)) as date) dd from (select cast(year(o_orderdate) as int) y from orders union select cast(year(l_shipdate) as int) from lineitem) where y is not null"
_LABEL_GRID = f"""with d as ({_DATES_ALL}),
 k as (select dd, cast(year(dd - to_months(m)) * 100 + month(dd - to_months(m)) as int) ym from (select dd, cast(date_trunc('month', dd) as date) from d) t(dd, md), (select unnest([0, 1, 2]) m)),
 b as materialized {_BAL}, v as materialized {_VEG},
 w as (select cell, dd, sum(wb) wb3 from k join b using (ym) group by 1, 2 having count(wb) = 3),
 bs as (select cell, ym % 100 mm, avg(r) wb_mean, stddev_pop(r) wb_std from (select cell, ym, case when count(wb) over o = 3 then sum(wb) over o end r from b window o as (partition by cell order by ym rows between 2 preceding and current row)) group by 1, 2),
 t as materialized {_TMAX},
 ts as (select cell, doy, sum(s1) / sum(n) mean, sqrt(greatest(sum(s2) / sum(n) - power(sum(s1) / sum(n), 2), 0)) std from (select cell, cast((dayofyear(dd) - 1 + k + 366) % 366 + 1 as int) doy, sum(tmax) s1, sum(tmax * tmax) s2, count(*) n
  from t, (select unnest(generate_series(-15, 15)) k) group by 1, 2) group by 1, 2),
 lim as (select cell, min(ndvi) ndvi_lo, max(ndvi) ndvi_hi, min(lst) lst_lo, max(lst) lst_hi from v group by 1),
 n as (select w.cell, w.dd, arg_min(ndvi, abs(v.dd - w.dd) * 1000000 + (v.dd - date '1990-01-01')) ndvi, arg_min(lst, abs(v.dd - w.dd) * 1000000 + (v.dd - date '1990-01-01')) lst from w join v on v.cell = w.cell and year(v.dd) = year(w.dd) group by 1, 2),
 i as (select w.cell, w.dd, case when wb_std > 0 then (wb3 - wb_mean) / wb_std end spei, case when std > 0 then (tmax - mean) / std end tmax_z, 0.5 * {_RATIO.format('ndvi - ndvi_lo', 'ndvi_hi - ndvi_lo')} + 0.5 * {_RATIO.format('lst_hi - lst', 'lst_hi - lst_lo')} vhi
  from w left join bs on bs.cell = w.cell and bs.mm = month(w.dd) left join t on t.cell = w.cell and t.dd = w.dd left join ts on ts.cell = w.cell and ts.doy = dayofyear(w.dd) left join n on n.cell = w.cell and n.dd = w.dd left join lim on lim.cell = w.cell)
 select cell, dd as "day", round(spei, 4) spei3, round(tmax_z, 4) tmax_z, round(vhi, 4) vhi, {_MASKED} cls from i"""


def _label_grid(spark, d, dates):
    precip, pet = monthly(spark, d, "precip"), monthly(spark, d, "pet")
    balance = precip.join(pet, ["cell", "ym"]).withColumn("wb", F.col("precip") - F.col("pet"))
    o, line = spark.read.parquet(f"{d}/orders.parquet"), spark.read.parquet(f"{d}/lineitem.parquet")
    tmax = o.groupBy((F.col("o_custkey") % 20).cast("int").alias("cell"), F.to_date("o_orderdate").alias("day")).agg(F.avg(20 + F.col("o_totalprice") % 25).alias("tmax"))
    veg = line.groupBy((F.col("l_suppkey") % 20).cast("int").alias("cell"), F.trunc("l_shipdate", "month").alias("day")).agg(F.avg(F.col("l_quantity") / 50).alias("ndvi"), F.avg(290 + F.col("l_discount") * 300).alias("lst"))
    limits = veg.groupBy("cell").agg(F.min("ndvi").alias("ndvi_lo"), F.max("ndvi").alias("ndvi_hi"), F.min("lst").alias("lst_lo"), F.max("lst").alias("lst_hi"))
    stats = Wn.circular_doy(A.doy_moments(tmax, ["cell"], F.dayofyear("day"), F.col("tmax")), ["cell"])
    out = labels.build_labels(dates, balance, Wn.water_balance(precip, pet, ["cell"]), tmax, stats, veg.withColumnRenamed("ndvi", "v"), veg.withColumnRenamed("lst", "v"), limits)
    return out.select("cell", "day", *[F.round(x, 4).alias(x) for x in ("spei3", "tmax_z", "vhi")], "cls")




@query(_LABEL_GRID)
def label_grid_all_years(spark, d):
    years = [spark.read.parquet(f"{d}/{t}.parquet").select(F.year(c).alias("year")) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    return _label_grid(spark, d, _composite_starts(years[0].union(years[1]), "day"))


from sondeframe.plans import more, rasters  # noqa: E402, F401  (register their queries)
