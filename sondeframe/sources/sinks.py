"""Sinks: idempotent appends, overwritten partitions, label rasters, reports."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions.names import clean_text
from sondeframe.operators.dataset import new_rows
from sondeframe.operators.splits import split_documents
from sondeframe.sources.published import publish, read_published


def append_index(rows: DataFrame, path: str, partitions: tuple[str, ...] = ("mgrs_tile", "year"), batch_id: str | None = None) -> int:
    """Append samples that the index doesn't hold, as one published batch; how many were new.

    With a batch id of its own a replay of the same append adds nothing, whatever it reads.
    """
    known = read_index(rows.sparkSession, path, rows.schema)
    return publish(new_rows(rows, known), path, batch_id, partitions) or 0


def read_index(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_published(spark, path, schema)


def overwrite_partitions(rows: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def encode_label(cls: Column) -> Column:
    """NULL to 255, as rasters at rest hold it."""
    return F.coalesce(cls, F.lit(C.NODATA)).cast("short")


def write_label_grid(labels: DataFrame, path: str) -> None:
    out = labels.withColumn("cls", encode_label(F.col("cls"))).repartition("label_date").sortWithinPartitions("lat_i", "lon_i")
    overwrite_partitions(out, path, ("label_date",))


def write_prevalence(counts: DataFrame, path: str) -> None:
    """``class,pixels,fraction`` as CSV: one row a class."""
    total = counts.agg(F.sum("n").alias("t"))
    out = counts.join(F.broadcast(total)).select(F.col("cls").alias("class"), F.col("n").alias("pixels"), F.try_divide("n", "t").alias("fraction"))
    out.coalesce(1).write.mode("overwrite").csv(path, header=True)


def report(rows: DataFrame) -> DataFrame:
    """One JSON document a row; text that isn't valid UTF-8 is mended first."""
    mended = [clean_text(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name) for f in rows.schema]
    return rows.select(F.to_json(F.struct(*mended)).alias("document"))


CLIMATOLOGY = "kind string, cell int, key int, mean double, std double, n long"


def write_climatology(path: str, doy: DataFrame, month: DataFrame, monthly: DataFrame) -> None:
    """The three tables of a climatology under one path, a partition for each kind, sorted by cell and key.

    ``doy(cell, doy, mean, std, n)``, ``month(cell, month, wb_mean, wb_std)`` and ``monthly(cell, ym,
    total)``, whose value is its ``mean``.  A kind that is written again replaces its own partition only.
    """
    none = lambda t: F.lit(None).cast(t)
    parts = [
        doy.select(F.lit("doy").alias("kind"), "cell", F.col("doy").cast("int").alias("key"), "mean", "std", "n"),
        month.select(F.lit("month").alias("kind"), "cell", F.col("month").cast("int").alias("key"), F.col("wb_mean").alias("mean"), F.col("wb_std").alias("std"), none("long").alias("n")),
        monthly.select(F.lit("monthly").alias("kind"), "cell", F.col("ym").cast("int").alias("key"), F.col("total").alias("mean"), none("double").alias("std"), none("long").alias("n")),
    ]
    whole = reduce(DataFrame.unionByName, parts)
    overwrite_partitions(whole.repartitionByRange("kind", "cell", "key").sortWithinPartitions("kind", "cell", "key"), path, ("kind",))


def write_split_documents(spark: SparkSession, path: str, cells: dict[tuple[int, int], str]) -> None:
    """The spatial and the temporal split as JSON documents, a row each: ``(kind, document)``; cells are some hundreds."""
    spatial, temporal = split_documents(cells)
    rows = [("spatial", json.dumps(spatial)), ("temporal", json.dumps(temporal))]
    spark.createDataFrame(rows, "kind string, document string").coalesce(1).write.mode("overwrite").json(path)
