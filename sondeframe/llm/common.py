"""Shared helpers: work folders, written stages and Arrow map wrappers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_base: str | None = None


def work_base(spark: SparkSession) -> str:
    """The folder that the cluster shares: ``spark.checkpoint.dir``; unset, a folder of our own (tests)."""
    global _own_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_base is None or not os.path.isdir(_own_base):
        _own_base = tempfile.mkdtemp(prefix="spark-sondeframe-")
    return f"file://{_own_base}"


def work_path(spark: SparkSession, name: str) -> str:
    return f"{work_base(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and outlives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def limited_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of a written table only when its counted rows are within ``max_rows``."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` bytes of one string column, however many rows a batch holds."""
    for batch in batches:
        texts = batch.column(column)
        wide = pa.types.is_large_string(texts.type)
        ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1)
        row = 0
        while row < batch.num_rows:
            upto = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1)
            yield batch.slice(row, upto - row)
            row = upto
