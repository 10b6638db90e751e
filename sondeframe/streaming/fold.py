"""Incremental folds by Structured Streaming: checkpointed accumulators and idempotent appends.

Each run takes what files are new (``availableNow``) and commits through the
stream's checkpoint, so a restart goes on where it stopped and a done file is
never read again.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe.operators.aggregates import merge_moments, moments
from sondeframe.sources.published import publish, read_published


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="spark-sondeframe-")
    return os.path.join(base, f"fold-{uuid.uuid4().hex}")


def _stream(spark: SparkSession, source: str, schema, files: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)


def upsert_fold(spark: SparkSession, source: str, schema, keys: list[str], partials: list, state: str, checkpoint: str, files: int = 16) -> None:
    """Fold new files into the state table: each batch writes its own partial sums, named by batch id, so replay overwrites."""

    def batch(df: DataFrame, batch_id: int) -> None:
        df.groupBy(*keys).agg(*partials).write.mode("overwrite").parquet(f"{state}/batch={batch_id:09d}")

    stream = _stream(spark, source, schema, files).writeStream.foreachBatch(batch)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def fold_moments(values: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, n, mean, m2)`` of ``value``, folded file by file through a checkpointed stream."""
    spark = values.sparkSession
    base = _folder(spark)
    values.write.parquet(f"{base}/in")
    upsert_fold(spark, f"{base}/in", values.schema, keys, moments(F.col("value")), f"{base}/state", f"{base}/checkpoint")
    return merge_moments(spark.read.parquet(f"{base}/state").drop("batch"), keys)


def fold_min_max(values: DataFrame, keys: list[str]) -> DataFrame:
    spark = values.sparkSession
    base = _folder(spark)
    values.write.parquet(f"{base}/in")
    partials = [F.min("value").alias("v_min"), F.max("value").alias("v_max")]
    upsert_fold(spark, f"{base}/in", values.schema, keys, partials, f"{base}/state", f"{base}/checkpoint")
    return merged(spark, f"{base}/state", keys, {"v_min": "min", "v_max": "max"})


def merged(spark: SparkSession, state: str, keys: list[str], how: dict[str, str]) -> DataFrame:
    return spark.read.parquet(state).drop("batch").groupBy(*keys).agg(*[F.expr(f"{f}({c})").alias(c) for c, f in how.items()])


def append_new(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: str = "sample_id") -> None:
    """Append rows whose key the published table ``target`` doesn't hold, a published batch for each micro-batch.

    A replayed micro-batch finds its id published and adds nothing; one that died before is written anew.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def batch(df: DataFrame, batch_id: int) -> None:
        known = read_published(df.sparkSession, target, df.schema).select(key)
        publish(df.dropDuplicates([key]).join(known, key, "left_anti"), target, f"{stream_id}-{batch_id:09d}")

    stream = _stream(spark, source, schema, 16).writeStream.foreachBatch(batch)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def daily_windows(events: DataFrame, keys: list[str], ts: str = "ts", value: str = "value", late: str = "1 day") -> DataFrame:
    """``(keys, day, n, mean, low, high)``: tumbling days, for a batch or a stream; a stream drops rows later than ``late``.

    Days are those of UTC; times without a zone are taken as they stand, whatever the session's zone.
    """
    if events.schema[ts].dataType.typeName() == "timestamp_ntz":
        events = events.withColumn(ts, F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp"))
    df = events.withWatermark(ts, late) if events.isStreaming else events
    v = F.col(value)
    g = df.groupBy(*keys, F.window(ts, "1 day").alias("_w")).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("_w.start")) / 86400).cast("int")).alias("day")
    return g.select(*keys, day, "n", "mean", "low", "high")


def stream_days(spark: SparkSession, source: str, schema, keys: list[str], target: str, checkpoint: str, ts: str = "ts", value: str = "value", late: str = "1 day", files: int = 1) -> None:
    """Daily values of hourly files as they arrive, by event time, into the published table ``target``.

    A day is put out once, when the watermark (the latest time seen less ``late``) has passed its end, so rows that
    come late within the bound still count in it.  State and progress lie in ``checkpoint``:
    a restart goes on with new files only, and a replayed micro-batch finds itself published.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def batch(df: DataFrame, batch_id: int) -> None:
        publish(df, target, f"{stream_id}-{batch_id:09d}")

    days = daily_windows(_stream(spark, source, schema, files), keys, ts, value, late)
    out = days.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint)
    out.trigger(availableNow=True).start().awaitTermination()
