"""Tables that grow by published batches.

A batch is written whole into a folder of its own, ``data/batch=<name>``; a marker
``published/<batch id>`` that holds this name then makes it part of the table.  Readers list
markers and read what they name, so an attempt that died halfway, or whose executors were
lost and whose tasks ran twice, is never seen.  A batch id that is published is never published again.
The marker is written aside and renamed, one step on file systems with an atomic
rename; one writer at a time works on a table, a lost one is followed by another.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, as Spark's own readers and writers use it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def published(spark: SparkSession, path: str) -> dict[str, str]:
    """batch id -> folder name of every published batch."""
    fs, where = _fs(spark, f"{path}/published")
    if not fs.exists(where):
        return {}
    out = {}
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if not name.startswith("."):
            stream = fs.open(status.getPath())
            try:
                out[unquote(name)] = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
    return out


def read_published(spark: SparkSession, path: str, schema, partitions: tuple[str, ...] = ()) -> DataFrame:
    """The rows of all published batches; an empty frame of that schema when there is none."""
    folders = [f"{path}/data/batch={name}" for name in sorted(published(spark, path).values())]
    if not folders:
        return spark.createDataFrame([], schema)
    # A batch without rows has no files, which a reader of the others needn't mind.
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*[f.name for f in schema])


def publish(rows: DataFrame, path: str, batch_id: str | None = None, partitions: tuple[str, ...] = ()) -> int | None:
    """Write ``rows`` as one batch; how many there are, or None when the batch id is published already."""
    spark = rows.sparkSession
    batch_id = batch_id or uuid.uuid4().hex
    if batch_id in published(spark, path):
        return None
    name = write_batch(rows, path, partitions)
    n = spark.read.schema(rows.schema).option("basePath", f"{path}/data").parquet(f"{path}/data/batch={name}").count()
    mark(spark, path, batch_id, name)
    return n


def write_batch(rows: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> str:
    """The name of a new folder of ``rows`` that no reader sees yet."""
    name = uuid.uuid4().hex
    rows.write.partitionBy(*partitions).parquet(f"{path}/data/batch={name}")
    return name


def mark(spark: SparkSession, path: str, batch_id: str, name: str) -> None:
    """Make a written folder part of the table."""
    fs, aside = _fs(spark, f"{path}/published/.{name}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    if not fs.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published/{quote(batch_id, safe='')}")):
        raise OSError(f"batch {batch_id} could not be published in {path}")
