"""Token counts: delta-maintained rollups by source, language and tokenizer version.

A change feed of signed rows becomes one small table of additive deltas for each
batch.  Totals are sums of deltas, so inserts (+1), deletes (-1) and revised counts
(the difference of tokens, no document) never touch earlier batches.

A batch is written under a name of the attempt's own and published by moving a
marker file, named by the batch id, into ``commits``; totals read what markers name
and nothing else, so an attempt in flight or dead halfway is never seen.  A marker
holds a digest of the batch's sums: committing a known id again with equal sums
changes nothing, with other sums it is an error.  ``compact`` folds committed batches
into the base of a new folder, with their ids and digests, so both still hold for them, and closes the
old folder: a later commit there is an error and not a change that no total shows.  One committer at a time works on a
rollup; a lost one is followed by another that commits the same batch again.

Edge cases: "base" is no batch id, as it names the folded batch; a null text has no tokens; null sources and languages are groups of
their own; totals that return to zero stay as zero rows; repeated rows each count; an
empty batch is committed like any other; columns of the documents called ``tokenizer``
or ``n_tokens`` give way to the new ones, others may have any name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes
from sondeframe.llm.files import open_fs
from sondeframe.llm.tokens import encoder

KEYS = ["source", "lang", "tokenizer"]
BASE, CLOSED = "base", "closed"
DELTA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"


def count_tokens(docs: DataFrame, tokenizers: dict[str, tuple[str, str]], text_col: str = "text") -> DataFrame:
    """``docs`` columns other than the text, with ``tokenizer`` (a version name) and ``n_tokens``; one row for each version."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text_col and c not in ("tokenizer", "n_tokens")]
    width = len(keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["tokenizer string", "n_tokens long"])
    free = "_text"
    while free in docs.columns:
        free += "_"
    source = docs.select(*keep, F.col(f"`{text_col}`").cast("string").alias(free))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, width):
            texts = batch.column(width).to_pylist()
            for name, (path, kind) in tokenizers.items():
                n = np.fromiter((len(ids) // 4 for ids in encoder(path, kind).encode(texts)), np.int64, len(texts))
                columns = [*batch.columns[:-1], pa.array([name] * len(texts), pa.string()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "tokenizer", "n_tokens"])

    return source.mapInArrow(run, schema)


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(1).cast("long").alias("d_docs"), F.col("n_tokens").alias("d_tokens"))


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(-1).cast("long").alias("d_docs"), (-F.col("n_tokens")).alias("d_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """A revised document leaves its old group with its old count and enters its new one."""
    return deletes(before).unionByName(inserts(after))


def _markers(rollup: str) -> dict[str, dict]:
    """batch id -> ``path``, ``digest`` and, of the base, ``folded``."""
    system, path = open_fs(f"{rollup}/commits")
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    out = {}
    for x in found:
        if x.base_name.endswith(".json"):
            with system.open_input_stream(x.path) as f:
                out[unquote(x.base_name[:-5])] = json.loads(f.read())
    return out


def _publish(rollup: str, batch_id: str, marker: dict) -> None:
    system, path = open_fs(f"{rollup}/commits")
    system.create_dir(path, recursive=True)
    name = f"{path}/{uuid.uuid4().hex}.open"
    with system.open_output_stream(name) as f:
        f.write(json.dumps(marker).encode())
    system.move(name, f"{path}/{quote(batch_id, safe='')}.json")


def _attempt(df: DataFrame, rollup: str) -> str:
    name = f"data/{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(f"{rollup}/{name}")  # one row a group
    return name


def _folded(spark: SparkSession, rollup: str, markers: dict[str, dict]) -> DataFrame:
    """``(batch_id, digest)`` of the batches that the base holds."""
    schema = "batch_id string, digest string"
    return spark.read.schema(schema).parquet(f"{rollup}/{markers[BASE]['folded']}") if BASE in markers else spark.createDataFrame([], schema)


def _digest(sums: DataFrame) -> str:
    """Of sums by key, whatever their order.  Each column counts with its place and whether it is null."""
    parts = [F.struct(F.lit(i), F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit(""))) for i, c in enumerate((*KEYS, "d_docs", "d_tokens"))]
    made = sums.agg(F.count("*"), F.bit_xor(F.xxhash64(*parts)), F.bit_xor(F.xxhash64(F.lit(1), *parts))).first()
    return ":".join(map(str, made))


def commit(changes: DataFrame, rollup: str, batch_id: str) -> bool:
    """Commit signed changes under ``batch_id``; False when it is committed already, also when it is folded."""
    if batch_id in (BASE, CLOSED):
        raise ValueError(f"{batch_id} is no name for a batch")
    spark, markers = changes.sparkSession, _markers(rollup)
    if CLOSED in markers:
        raise ValueError(f"this rollup went on in {markers[CLOSED]['into']}")
    sums = changes.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
    name = _attempt(sums, rollup)
    digest = _digest(spark.read.schema(DELTA).parquet(f"{rollup}/{name}"))
    known = markers[batch_id]["digest"] if batch_id in markers else None
    if known is None:
        folded = _folded(spark, rollup, markers).where(F.col("batch_id") == batch_id).first()
        known = folded["digest"] if folded else None
    if known is None:
        _publish(rollup, batch_id, {"path": name, "digest": digest})
        return True
    if known != digest:
        raise ValueError(f"batch {batch_id} is committed with other sums")
    return False


def _sums(spark: SparkSession, rollup: str, markers: dict[str, dict]) -> DataFrame:
    paths = [f"{rollup}/{m['path']}" for m in markers.values() if "path" in m]
    deltas = spark.read.schema(DELTA).parquet(*paths) if paths else spark.createDataFrame([], DELTA)
    return deltas.groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))


def totals(spark: SparkSession, rollup: str) -> DataFrame:
    """``(source, lang, tokenizer, n_docs, n_tokens)`` over the committed batches."""
    return _sums(spark, rollup, _markers(rollup))


def compact(spark: SparkSession, rollup: str, into: str) -> None:
    """Publish the present totals as the base of a new rollup folder, with the ids and digests of all batches in it.

    The old folder is closed first; a compaction that died after that is done again with the same ``into``.
    """
    markers = _markers(rollup)
    if CLOSED in markers and markers[CLOSED]["into"] != into:
        raise ValueError(f"this rollup went on in {markers[CLOSED]['into']}")
    if BASE in _markers(into):
        return
    _publish(rollup, CLOSED, {"into": into})
    new = spark.createDataFrame([(b, m["digest"]) for b, m in markers.items() if b not in (BASE, CLOSED)], "batch_id string, digest string")
    folded = _attempt(_folded(spark, rollup, markers).unionByName(new), into)
    sums = _sums(spark, rollup, markers).select(*KEYS, F.col("n_docs").alias("d_docs"), F.col("n_tokens").alias("d_tokens"))
    _publish(into, BASE, {"path": _attempt(sums, into), "digest": "", "folded": folded})
