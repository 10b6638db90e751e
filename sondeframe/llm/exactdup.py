"""Exact duplicates: sorted digest runs that partitions exchange and merge in rounds, as a binomial tree.

Plan
  1. One native pass writes, for each row, the SHA-256 of its normalised text, its
     length in bytes and a second hash; the reading task's number is its run.
  2. Each task folds its rows into a run: sorted by digest, equal texts as one entry
     that keeps the smallest identifier and the number of rows.
  3. Runs are numbered in base 16.  In round j the 16 runs that differ in digit j
     only exchange parts: each gets the entries whose digest has its own digit as
     j-th hexadecimal figure, merges the 16 parts, keeps the smallest identifier of
     equal entries, and is sorted anew.  After ceil(log16(runs)) rounds a digest is in
     one run only.  Every round deals all entries to all tasks; none holds a run of
     everything, and a text that a third of all rows share is one entry of each run.
  4. Groups of two rows or more return to the first runs, and from there to the rows by
     (run, digest), so the rows of a large group never meet under one key.

An entry is merged only with one of equal digest, equal length and equal second hash
(verified at each level); entries that agreed in the digest alone would stay apart.

Edge cases: null texts count as empty and are equal to each other; ids may be null
(they come last among identifiers) or repeat; of rows that share the smallest id,
the one read first stays; an empty table gives no rows; very long texts are digested
whole by the JVM; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondeframe.llm.common import written

FAN = 16
#: Entries that a task holds while it folds its rows; then they go out as a sorted piece of its run.
FOLD_ROWS = 1 << 18
KEY = ["digest", "n_bytes", "mark"]
_ENTRY = "run long, digest string, n_bytes long, mark long, first struct<absent:boolean,id:long,row:long>, size long"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, run, id, digest, n_bytes, mark``: one row for each input row."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("text"))
    return source.select(
        F.monotonically_increasing_id().alias("row"), F.spark_partition_id().cast("long").alias("run"), "id",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("mark"),
    )


def _merged(table: pa.Table) -> pa.Table:
    """Entries ``run, KEY, absent, id, row, size``, those of one run and key as one, sorted by key."""
    at = [("run", "ascending"), *[(k, "ascending") for k in KEY], ("absent", "ascending"), ("id", "ascending"), ("row", "ascending")]
    table = table.sort_by(at)
    sums = table.group_by(["run", *KEY], use_threads=False).aggregate([("absent", "first"), ("id", "first"), ("row", "first"), ("size", "sum")])
    sums = sums.rename_columns([c.removesuffix("_first").removesuffix("_sum") for c in sums.column_names])
    return sums.sort_by([("run", "ascending"), *[(k, "ascending") for k in KEY]])


def _entries(table: pa.Table) -> Iterator[pa.RecordBatch]:
    table = table.combine_chunks()
    for batch in table.to_batches(max_chunksize=1 << 14):
        first = pa.StructArray.from_arrays([batch.column("absent"), batch.column("id"), batch.column("row")], ["absent", "id", "row"])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("run", *KEY)), first, batch.column("size")], ["run", *KEY, "first", "size"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows as sorted pieces of its run; equal texts of a piece are one entry."""
    held, n = [], 0
    for batch in batches:
        one = pa.table({
            "run": batch.column("run"), **{k: batch.column(k) for k in KEY}, "absent": pc.is_null(batch.column("id")),
            "id": batch.column("id"), "row": batch.column("row"), "size": pa.repeat(pa.scalar(1, pa.int64()), batch.num_rows),
        })
        held.append(one)
        n += one.num_rows
        if n >= FOLD_ROWS:
            held = [_merged(pa.concat_tables(held))]
            n = held[0].num_rows
            if n >= FOLD_ROWS // 2:
                yield from _entries(held[0])
                held, n = [], 0
    if n:
        yield from _entries(_merged(pa.concat_tables(held)))


def merge_round(runs: DataFrame, digit: int) -> DataFrame:
    """Runs that differ in one digit exchange parts by the digest's figure; each merges what it gets."""
    step = FAN**digit
    own = F.pmod(F.floor(F.col("run") / step), F.lit(FAN))
    figure = F.conv(F.substring("digest", digit + 1, 1), 16, 10).cast("long")
    dealt = runs.withColumn("run", F.col("run") + (figure - own) * step).repartition("run")
    merged = dealt.groupBy("run", *KEY).agg(F.min("first").alias("first"), F.sum("size").alias("size"))
    return merged.sortWithinPartitions("run", *KEY)


def tree_merge(runs: DataFrame, n_runs: int) -> DataFrame:
    """One entry for each text, after as many rounds as ``n_runs`` has digits."""
    digit = 0
    while FAN**digit < n_runs:
        runs = written(merge_round(runs, digit), f"runs{digit + 1}")
        digit += 1
    return runs


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``: one row for each input row.

    Of rows with equal normalised texts the one of smallest id is kept, exactly one.
    """
    rows = written(digests(docs, id_col, text_col), "digests")
    runs = written(rows.mapInArrow(_fold, _ENTRY), "runs0")
    last = rows.agg(F.max("run")).first()[0]
    n_runs = 0 if last is None else last + 1
    # A run may have come in pieces, so there is a round even for a single run.
    whole = tree_merge(runs, max(2, n_runs))
    groups = whole.where("size > 1").select(*KEY, F.col("first").alias("keep"), F.col("size").alias("group_size"))
    placed = runs.select("run", *KEY).distinct().join(groups, KEY)
    out = rows.join(placed, ["run", *KEY], "left")
    alone = F.col("keep").isNull()
    return out.select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep.row") == F.col("row"))).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are named by their id here: rows that share an id with a row that stays all
    stay, and rows without an id always do.
    """
    gone = exact_duplicates(docs, id_col, text_col).groupBy("id").agg(F.max("kept").alias("stays")).where("not stays and id is not null")
    return docs.join(gone.select(F.col("id").alias("__gone")), F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
