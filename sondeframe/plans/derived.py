"""Grids, series, sites and scenes derived from the given tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name -> (table, {column: expression in Spark}, {column: expression in DuckDB where it differs})
DERIVED = {
    "pixel": ("lineitem", {
        "pixel": "l_orderkey", "year": "cast(year(l_shipdate) as int)", "cls_key": "cast(l_suppkey % 7 as int)",
        "spei": "case when l_linenumber = 7 then null else l_quantity / 10 - 2.5 end",
        "tmax_z": "l_tax * 50 - 0.5", "vhi": "cast(l_partkey % 100 as double)",
    }, {}),
    "raster": ("lineitem", {
        "pixel": "l_orderkey", "ndvi": "l_quantity / 50", "ndvi_lo": "l_tax", "ndvi_hi": "l_tax + l_discount * 9",
        "lst": "290 + l_quantity / 2", "lst_lo": "cast(285 as double)", "lst_hi": "cast(320 as double)",
        "wb3": "l_extendedprice / 1000 - 60", "wb_mean": "l_discount * 10", "wb_std": "l_tax * 300",
        "tmax": "20 + l_quantity / 2", "t_mean": "cast(30 as double)", "t_std": "l_discount * 40",
    }, {}),
    "site": ("customer", {
        "id": "c_custkey", "lon": "22 + cast((c_custkey * 37) % 1400 as double) / 100", "lat": "30 + cast((c_custkey * c_custkey) % 701 as double) / 100",
    }, {}),
    "hourly": ("events", {"cell": "cast(user_id % 16 as int)", "ts": "ts", "t2m": "273.15 + value / 10", "swvl1": "value / 997", "e": "-value / 99991", "tp": "value / 9973"}, {}),
    "scene": ("orders", {
        "id": "concat('HLS.', case when o_orderkey % 2 = 0 then 'S30' else 'L30' end, '.T36RUU.', date_format(o_orderdate, 'yyyyDDD'), 'T082611.v2.0')",
        "day": "cast(o_orderdate as date)", "cloud": "case when o_orderkey % 11 = 0 then null else o_totalprice % 100 end", "k": "o_orderkey",
    }, {"id": "concat('HLS.', case when o_orderkey % 2 = 0 then 'S30' else 'L30' end, '.T36RUU.', strftime(o_orderdate, '%Y%j'), 'T082611.v2.0')"}),
    "fmask": ("events", {
        "patch": "cast(floor(event_id / 200) as int)", "fmask": "cast(case when event_id % 13 = 0 then 255 else (event_id * 7) % 64 end as int)",
        "red": "cast(case when event_id % 17 = 0 then -9999 else event_id % 3000 end as int)",
    }, {}),
    "label": ("lineitem", {
        "day": "cast(date_trunc('month', l_shipdate) as date)", "tile": "cast(l_suppkey % 5 as int)", "row": "cast(l_partkey % 16 as int)", "col": "cast(l_orderkey % 16 as int)",
        "cls": "cast(case when l_linenumber = 7 then 255 else l_quantity % 4 end as int)",
    }, {}),
    "indexed": ("orders", {
        "sample_id": "cast(o_orderkey as string)", "day": "cast(o_orderdate as date)", "center_lon": "22 + cast((o_custkey * 37) % 1400 as double) / 100",
        "center_lat": "case when o_orderkey % 97 = 0 then 95.0 else 30 + cast((o_custkey * o_custkey) % 701 as double) / 100 end",
        "cloud_pct": "(o_totalprice % 101) / 100", "valid_pct": "cast(1 as double)",
        "region": "case when o_orderkey % 3 = 0 then 'delta' when o_orderkey % 89 = 0 then 'sea' else 'em_shelf' end",
        "split": "case o_orderkey % 6 when 0 then 'train' when 1 then 'val' when 2 then 'test' when 3 then 'ood' when 4 then 'buffer' else 'none' end",
    }, {"sample_id": "cast(o_orderkey as varchar)"}),
}
MONTHLY = {
    "precip": ("orders", "cast(o_custkey % 20 as int)", "o_orderdate", "sum(o_totalprice) / 1e5"),
    "pet": ("lineitem", "cast(l_suppkey % 20 as int)", "l_shipdate", "sum(l_extendedprice) / 1e6"),
}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns, _ = DERIVED[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*[f"{e} as `{c}`" for c, e in columns.items()])


def sql(name: str) -> str:
    """A derived table as a DuckDB subquery."""
    table, columns, other = DERIVED[name]
    return "(select " + ", ".join(f'{other.get(c, e)} as "{c}"' for c, e in columns.items()) + f" from {table})"


def monthly(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, cell, day, total = MONTHLY[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr("*", f"{cell} as cell", f"cast(year({day}) * 100 + month({day}) as int) as ym")
    return df.groupBy("cell", "ym").agg(_expr(total).alias(name))


def _expr(text: str):
    from pyspark.sql import functions as F

    return F.expr(text)


def monthly_sql(name: str) -> str:
    table, cell, day, total = MONTHLY[name]
    return f"(select {cell} as cell, cast(year({day}) * 100 + month({day}) as int) as ym, {total} as {name} from {table} group by 1, 2)"
