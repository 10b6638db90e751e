"""Input locators, documents and text that isn't valid."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import names
from sondeframe.operators import catalog, splits
from sondeframe.sources import readers, sinks


def test_files_are_found_and_parsed_without_reading_them(spark, tmp_path):
    for name in ("HLS.S30.T36RUU.2023213T082611.v2.0.B04.tif", "sub/label_2023-07-28.tif", "sub/MOD13Q1.A2023209.h20v05.tif", "notes.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = {r.path.rsplit("/", 1)[1]: r for r in readers.list_files(spark, str(tmp_path), "*.tif").collect()}
    assert len(got) == 3 and got["label_2023-07-28.tif"].day == dt.date(2023, 7, 28)
    hls = got["HLS.S30.T36RUU.2023213T082611.v2.0.B04.tif"]
    assert (hls.day, hls.sensor, hls.tile) == (dt.date(2023, 8, 1), "S30", "T36RUU") and got["MOD13Q1.A2023209.h20v05.tif"].grid_tile == "h20v05"


def test_tiled_inputs_of_a_year(spark):
    files = spark.createDataFrame([(f"s3/x/{n}",) for n in ("tiles_T36RUU_2023.parquet", "tiles_T35RPN_2023.parquet", "tiles_T36RUU_2023_labeled.parquet", "tiles_T36RUU_2022.parquet", "other.parquet")], "path string")
    names_of = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    assert names_of(readers.tiled_inputs(files, 2023)) == ["tiles_T35RPN_2023.parquet", "tiles_T36RUU_2023.parquet"]
    assert names_of(readers.tiled_inputs(files, 2023, ["T36RUU"])) == ["tiles_T36RUU_2023.parquet"]


def test_months_of_a_window(spark):
    ends = spark.createDataFrame([(dt.date(2020, 3, 31),), (dt.date(2020, 1, 1),)], "end date")
    assert sorted(map(tuple, readers.months_spanning(ends, "end").collect())) == [(2019, 10), (2019, 11), (2019, 12), (2020, 1), (2020, 2), (2020, 3)]


def test_split_documents_come_back(spark, tmp_path):
    cells = splits.assign_cells(splits.box_cells(C.ROI), splits.box_cells(C.OOD))
    sinks.write_split_documents(spark, str(tmp_path / "s"), cells)
    docs = {r.kind: json.loads(r.document) for r in readers.read_table(spark, str(tmp_path / "s"), "json", "kind string, document string").collect()}
    assert docs["spatial"]["counts"] == {"train": 69, "val": 15, "test": 14, "ood": 154} and docs["spatial"]["cells"]["22_30"] == cells[22, 30] and len(docs["spatial"]["cells"]) == 252
    assert docs["temporal"]["assignment"]["2017"] == "train" and docs["temporal"]["assignment"]["2024"] == "ood_time" and docs["temporal"]["test_years"] == [2023]


def test_climatology_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "c")
    doy = spark.createDataFrame([(1, 5, 1.0, 0.5, 3)], "cell int, doy int, mean double, std double, n long")
    month = spark.createDataFrame([(1, 2, 3.0, 0.1)], "cell int, month int, wb_mean double, wb_std double")
    monthly = spark.createDataFrame([(1, 202001, 7.0)], "cell int, ym int, total double")
    sinks.write_climatology(path, doy, month, monthly)
    sinks.write_climatology(path, doy.where("false"), month.withColumn("wb_mean", F.lit(9.0)), monthly.where("false"))
    got = {r.kind: (r.cell, r.key, r["mean"]) for r in readers.read_table(spark, path, "parquet", sinks.CLIMATOLOGY).collect()}
    assert got == {"doy": (1, 5, 1.0), "month": (1, 2, 9.0), "monthly": (1, 202001, 7.0)}


def test_invalid_text_is_mended(spark):
    df = spark.range(1).select(F.expr("cast(X'61FF62' as string)").alias("t"), F.lit(3).alias("n"))
    assert df.select(names.clean_text(F.col("t"))).first()[0] == "a�b"
    assert json.loads(sinks.report(df).first()[0]) == {"t": "a�b", "n": 3}


def test_scene_strategies(spark):
    with pytest.raises(ValueError):
        catalog.resolve_scenes(spark.range(1), "ftp")
    with pytest.raises(ValueError):
        catalog.resolve_scenes(spark.range(1), "catalog")
