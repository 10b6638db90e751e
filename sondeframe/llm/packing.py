"""Best-fit packing of documents into sequences of a fixed capacity.

Documents are range-sorted by length and go, the longest first, in bands of lengths.
Each round of a band is bulk-synchronous: a sweep over documents and gaps in falling
order hands every document its successor, the smallest free gap that holds it; of
those that want one gap the rank decides; gaps are updated; the next round begins.
When no gap holds a band's smallest document left, new sequences are opened.

A sweep is a stack: gaps go on it, documents take its top.  The heights at which the
rows of one length start follow from the counts by length, at most ``capacity``
numbers, which is all that the driver sees; documents and gaps get their ranks on the
executors and meet by height in one shuffle (``_matched``).  A round costs the band's
documents and the open gaps, two longs each.

Edge cases: a null text is an empty document, which still has its end id; texts
longer than the capacity are cut with the short piece first; pieces of the full
capacity are sequences of their own, with negative numbers; null ids, ties and repeated rows
are packed like any other row; other columns are not read, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes, written
from sondeframe.llm.tokens import encoder

#: Documents of one length are ranked in groups of about this many rows.
RANK_ROWS = 250_000
PLAN = "value long, before long, after long, placed long, done long, fold long"
#: A band ends at this share of its longest document.
BAND = 0.75
#: Parts of the table of open gaps before they are written as one.
MAX_POOLS = 6


def pieces(docs: DataFrame, tokenizer: str, kind: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, _row)`` of each document's ids and end id; ``_row`` is unique once written."""
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, kind)
        at_row = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, 1):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode.encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                at, size = 0, (n - 1) % capacity + 1
                for p in range(-(-n // capacity)):
                    row.append(i)
                    piece.append(p)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    at, size = at + size, capacity
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, range(at_row, at_row + len(row)))]
            at_row += len(row)
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "_row"])

    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, _row long")


def sweep_plan(docs: dict[int, int], slots: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """``(value, before, after, placed)`` of one sweep from the largest value down, at most ``capacity`` rows.

    Slots go on a stack, a document takes the top one, which is its successor: the
    smallest slot that is free and holds it.  ``before`` and ``after`` are the heights
    of the stack before and after the slots of a value are put on it; the first
    ``placed`` of its documents, by rank, then take theirs.
    """
    out, height = [], 0
    for value in sorted(docs.keys() | slots.keys(), reverse=True):
        before, height = height, height + slots.get(value, 0)
        placed = min(height, docs.get(value, 0))
        out.append((value, before, height, placed))
        height -= placed
    return out


def _ranked(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """``_rank`` of each row among those of its value; a value that many rows share is counted in salted groups."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(max(16, -(-n // RANK_ROWS)))))
    counts = salted.groupBy(value, "_salt").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(value).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(value, "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy(value, "_salt").orderBy(key)) - 1
    return salted.withColumn("_rank", within).join(counts, [value, "_salt"]).withColumn("_rank", F.col("_before") + F.col("_rank")).drop("_salt", "_before")


def _matched(docs: DataFrame, slots: DataFrame) -> DataFrame:
    """``slots`` with the ``_row`` and ``length`` of the document that takes each, or nulls.

    At one height of the stack a document takes the slot put there last, the row
    before it; a height is left and reached at most once for each value, so its group
    has at most two rows for each of ``capacity`` values.
    """
    rows = slots.withColumn("kind", F.lit(0)).unionByName(docs.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    order = W.partitionBy("level").orderBy(F.desc("value"), "kind")
    taken = F.lead("kind").over(order) == 1
    rows = rows.withColumn("length", F.when(taken, F.lead("value").over(order))).withColumn("_row", F.when(taken, F.lead("_row").over(order)))
    return rows.where("kind = 0").drop("kind", "level", "value")


def _filled(slots: DataFrame, capacity: int, several: bool) -> DataFrame:
    """``(sequence_id, _row, offset, left)``: ``left`` is the gap that remains, once for each sequence."""
    if not several:
        left = F.col("gap") - F.coalesce("length", F.lit(0).cast("long"))
        return slots.select("sequence_id", "_row", (capacity - F.col("gap")).alias("offset"), left.alias("left"))
    own = W.partitionBy("sequence_id")
    earlier = own.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    offset = capacity - F.col("gap") + F.coalesce(F.sum("length").over(earlier), F.lit(0))
    left = F.when(F.col("slot") == 0, F.col("gap") - F.coalesce(F.sum("length").over(own), F.lit(0)))
    return slots.select("sequence_id", "_row", offset.alias("offset"), left.alias("left"))


def _band_end(high: int, capacity: int, ratio: float) -> int:
    """The largest length below the band that starts at ``high``: no two above half the capacity share a sequence; short ones fit anywhere."""
    if 2 * high > capacity:
        return capacity // 2
    return int(high * ratio) if 16 * high > capacity else 0


def best_fit(items: DataFrame, capacity: int, ratio: float = BAND) -> DataFrame:
    """Append ``sequence_id`` and ``offset`` to a written table with a unique ``_row`` and a ``length`` of 1..capacity."""
    spark = items.sparkSession
    counts = {r["length"]: r["count"] for r in items.where(F.col("length") < capacity).groupBy("length").count().collect()}  # < capacity rows
    total = sum(counts.values())
    whole = items.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    if not total:
        return whole.drop("_row")
    ranked = _ranked(items.where(F.col("length") < capacity).select("_row", F.col("length").alias("value")), "value", "_row", total)
    ranked = written(ranked.repartitionByRange("value", "_rank").sortWithinPartitions("value", "_rank"), "sorted")
    pools: list[DataFrame] = []  # the open gaps ``(sequence_id, gap)``, as parts of written tables
    done = dict.fromkeys(counts, 0)  # documents of a length that have their place: the first ones by rank
    fresh, rounds = 0, []
    while any(done[v] < n for v, n in counts.items()):
        low = _band_end(max(v for v, n in counts.items() if done[v] < n), capacity, ratio)
        while left := {v: n - done[v] for v, n in counts.items() if v > low and done[v] < n}:
            most, least = max(left), min(left)
            usable = [p.where(F.col("gap") >= least) for p in pools]
            usable = reduce(DataFrame.unionByName, usable) if usable else None
            have = {r["gap"]: r["count"] for r in usable.groupBy("gap").count().collect()} if usable else {}  # <= capacity rows
            if have:
                open_ = _ranked(usable, "gap", "sequence_id", sum(have.values()))
            else:
                need = -(-sum(left.values()) // (capacity // most))
                open_ = spark.range(need).select((F.col("id") + fresh).alias("sequence_id"), F.lit(capacity).cast("long").alias("gap"), F.col("id").alias("_rank"))
                fresh, have = fresh + need, {capacity: need}
            # A gap that holds several of the largest documents offers that many slots.
            fold = {v: max(1, v // most) for v in have}
            plan = sweep_plan(left, {v: n * fold[v] for v, n in have.items()}, capacity)
            steps = spark.createDataFrame([(*r, done.get(r[0], 0), fold.get(r[0], 1)) for r in plan], PLAN)
            steps = F.broadcast(steps)  # at most `capacity` rows
            docs = ranked.where(F.col("value").between(least, most)).join(steps, "value")
            docs = docs.where((F.col("_rank") >= F.col("done")) & (F.col("_rank") < F.col("done") + F.col("placed")))
            docs = docs.select("value", "_row", (F.col("after") - 1 - (F.col("_rank") - F.col("done"))).alias("level"))
            slots = open_.withColumn("value", F.col("gap")).join(steps, "value")
            several = max(fold.values()) > 1
            slots = slots.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fold") - 1)) if several else F.lit(0).cast("long"))
            level = F.col("before") + F.col("_rank") * F.col("fold") + F.col("slot")
            made = _filled(_matched(docs, slots.select("value", "sequence_id", "gap", "slot", level.alias("level"))), capacity, several)
            rounds.append(written(made, "round"))
            pools = [p.where(F.col("gap") < least) for p in pools] + [rounds[-1].where("left > 0").select("sequence_id", F.col("left").alias("gap"))]
            if len(pools) > MAX_POOLS:
                pools = [written(reduce(DataFrame.unionByName, pools), "gaps")]
            for value, _, _, n in plan:
                if n:
                    done[value] += n
    found = reduce(DataFrame.unionByName, [r.where("_row is not null").select("_row", "sequence_id", "offset") for r in rounds])
    return items.join(found, "_row").unionByName(whole).drop("_row")


def pack(
    docs: DataFrame, tokenizer: str, kind: str = "byte", capacity: int = 2048, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row for each piece."""
    return best_fit(written(pieces(docs, tokenizer, kind, capacity, end_id, id_col, text_col), "pieces"), capacity)
