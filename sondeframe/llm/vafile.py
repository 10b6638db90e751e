"""Hard negatives by a vector-approximation file: score bounds from cells, exact scores for what they leave open.

Plan
  1. Each dimension's integers are dealt to 2 ** ``bits`` cells.  Inner borders are
     quantiles of at most ``FIT_ROWS`` vectors; the outer ones are the extremes of all
     rows, so every row's cells bound it, whatever the sample was.
  2. The file: for blocks of about ``BLOCK_ROWS`` rows the ids, labels and one byte
     of cell number a dimension.  Of equal vectors of one label only as many smallest ids
     are filed as one answer could hold; the others lose every tie, so nothing is lost.
  3. A scan looks up both borders of each cell in a table; their sums weighted by an
     anchor's components bound its score from below and above.  Blocks of anchors
     meet blocks of the file by an equi-join on (anchor block, lane of file blocks).
     For each window (bounds on the score) of an anchor, a row whose bounds lie wholly inside it
     surely enters; the k-th best lower bound of such rows, ties by id, rules out what
     lies below.  What is left of a lane is thinned again over all lanes.
  4. Only these open rows are fetched, by one equi-join, and scored exactly.
  The first scan takes rows of the anchor's label without limits and gives the positives; the
  second takes the other labels with a window for each positive.

When bounds decide little (an anchor whose window lies among most scores, or few
rows of its label), more rows stay open, never fewer: the answer is always exact.

Edge cases: rows with a null id, label, vector or component, or of another length than
the longest, take no part; of rows that share an id the least (label, vector) does; ties
go to the smaller id; a component beyond ``LIMIT`` is an error, as sums must stay exact in
double precision; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe.llm.common import written

#: A code is one byte whatever the number; more cells leave fewer rows open.
BITS = 8
FIT_ROWS = 20_000
BLOCK_ROWS = 2048
ANCHOR_ROWS = 256
#: File blocks that one lane scans for one block of anchors.
LANE_BLOCKS = 8
#: Open rows of one window after which a lane thins them.
THIN_ROWS = 4096
LIMIT = 1 << 20
_OPEN = "anchor_id long, target long, id long, low double, high double, sure boolean"


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    values = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).reshape(-1, dims)


class Cells:
    """Borders of the cells of every dimension, and codes by them."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> None:
        n = 1 << bits
        at = np.linspace(0, 1, n + 1)[1:-1]
        self.inner = np.sort(np.quantile(sample, at, axis=0, method="nearest"), axis=0).T.astype(np.int64)  # (dims, n - 1)
        below = np.concatenate((low[:, None], self.inner), axis=1).astype(np.float64)
        above = np.concatenate((self.inner - 1, high[:, None]), axis=1).astype(np.float64)
        above = np.maximum(above, below)  # a cell that holds no integer
        self.middle, self.half = ((below + above) / 2).ravel(), ((above - below) / 2).ravel()
        self.first = np.arange(len(low), dtype=np.intp) * n

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for d in range(x.shape[1]):
            out[:, d] = np.searchsorted(self.inner[d], x[:, d], side="right")
        return out

    def bounds(self, codes: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (asked, rows) of the inner products; whole or half numbers, so exact."""
        cell = codes.astype(np.intp) + self.first
        centre = asked @ self.middle[cell].T
        reach = np.abs(asked) @ self.half[cell].T
        return centre - reach, centre + reach


class _Window:
    """What of one window of one anchor is open: rows that may still be among its first k."""

    def __init__(self, target: int, low: float, high: float, k: int) -> None:
        self.target, self.low, self.high, self.k = target, low, high, k
        self.best: list[tuple[float, int]] = []  # the k best (-lower bound, id) of rows that surely enter
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n, self.limit = 0, THIN_ROWS

    def floor(self) -> float:
        return max(self.low, -self.best[-1][0]) if len(self.best) == self.k else self.low

    def _kept(self, ids: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(self.best) < self.k:
            return np.ones(len(ids), bool)
        worst = self.best[-1]
        return (high > -worst[0]) | ((high == -worst[0]) & (ids <= worst[1]))

    def see(self, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        may = (high >= self.floor()) & (low <= self.high)
        if not may.any():
            return
        ids, low, high = ids[may], low[may], high[may]
        sure = (low >= self.low) & (high <= self.high)
        if sure.any():
            least, named = -low[sure], ids[sure]
            top = np.lexsort((named, least))[: self.k]
            self.best = sorted([*self.best, *zip(least[top].tolist(), named[top].tolist(), strict=True)])[: self.k]
        keep = self._kept(ids, high)
        self.held.append((ids[keep], low[keep], high[keep], sure[keep]))
        self.n += int(keep.sum())
        if self.n > self.limit:
            self.thin()
            self.limit = max(THIN_ROWS, 2 * self.n)

    def thin(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return ()
        parts = tuple(np.concatenate(x) for x in zip(*self.held, strict=True))
        keep = self._kept(parts[0], parts[2]) & (parts[2] >= self.low)
        parts = tuple(x[keep] for x in parts)
        self.held, self.n = [parts], len(parts[0])
        return parts


def _blocks(df: DataFrame, n: int, name: str) -> DataFrame:
    """Rows in ``n`` blocks by a hash of the id: one row a block, of about equal sizes."""
    return df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).groupBy(name).agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns]))).alias("rows"))


def _scan(file: DataFrame, asked: DataFrame, n_rows: int, n_asked: int, cells, dims: int, same_label: bool, k: int) -> DataFrame:
    """Open rows (``_OPEN``) of ``file(id, label, code)`` for ``asked(id, label, v, windows<target, low, high>)``."""
    n_blocks, n_asks = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_asked // ANCHOR_ROWS))
    lanes = -(-n_blocks // LANE_BLOCKS)
    tasks = max(int(file.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_asks * lanes // 4)
    blocks = _blocks(file, n_blocks, "block").select((F.col("block") % lanes).alias("lane"), F.explode(F.sequence(F.lit(0), F.lit(n_asks - 1))).alias("ask"), "rows")
    asks = _blocks(asked, n_asks, "ask").select("ask", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.col("rows").alias("asked"))
    met = blocks.repartition(tasks, "ask", "lane").join(asks.repartition(tasks, "ask", "lane"), ["ask", "lane"])
    met = met.select("ask", "lane", "rows.id", "rows.label", "rows.code", F.col("asked.id").alias("anchor"), F.col("asked.label").alias("own"), F.flatten("asked.v").alias("v"), "asked.windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = cells.value
        now, anchors = None, []

        def left() -> Iterator[pa.RecordBatch]:
            for anchor, windows in anchors:
                for w in windows:
                    parts = w.thin()
                    if parts and len(parts[0]):
                        n = len(parts[0])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, anchor)), pa.array(np.full(n, w.target)), *map(pa.array, parts)], ["anchor_id", "target", "id", "low", "high", "sure"]
                        )

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                key = (row["ask"].as_py(), row["lane"].as_py())
                if key != now:
                    yield from left()
                    now = key
                    v = row["v"].values.to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
                    names, own = row["anchor"].values.to_numpy(), row["own"].values.to_numpy()
                    anchors = [(a, [_Window(w["target"], w["low"], w["high"], k) for w in ws]) for a, ws in zip(names.tolist(), row["windows"].as_py(), strict=True)]
                ids, label = row["id"].values.to_numpy(), row["label"].values.to_numpy()
                codes = np.frombuffer(b"".join(row["code"].as_py()), np.uint8).reshape(len(ids), dims)
                for at in range(0, len(names), 64):
                    low, high = borders.bounds(codes, v[at : at + 64])
                    for i, (anchor, windows) in enumerate(anchors[at : at + 64]):
                        fits = (label == own[at + i]) if same_label else (label != own[at + i])
                        fits &= (ids != anchor) & (high[i] >= min(w.floor() for w in windows)) & (low[i] <= max(w.high for w in windows))
                        found = np.flatnonzero(fits)
                        if len(found):
                            some = ids[found], low[i, found], high[i, found]
                            for w in windows:
                                w.see(*some)
        yield from left()

    open_ = met.mapInArrow(run, _OPEN)
    # Over all lanes: what the k-th best row that surely enters rules out.
    of = W.partitionBy("anchor_id", "target")
    kth = F.when(F.col("sure") & (F.col("nth") == k), F.struct((-F.col("low")).alias("low"), "id"))
    open_ = open_.withColumn("nth", F.row_number().over(of.orderBy(F.desc("sure"), F.desc("low"), "id"))).withColumn("worst", F.max(kth).over(of))
    beaten = (F.col("high") < -F.col("worst.low")) | ((F.col("high") == -F.col("worst.low")) & (F.col("id") > F.col("worst.id")))
    return open_.where(F.col("worst").isNull() | ~beaten).select("anchor_id", "target", "id")


def _scored(pairs: DataFrame, rows: DataFrame, dims: int) -> DataFrame:
    """``anchor_id, id, score`` of distinct pairs, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.einsum("ij,ij->i", _matrix(batch.column(2), dims), _matrix(batch.column(3), dims))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.int64())], ["anchor_id", "id", "score"])

    pairs = pairs.select("anchor_id", "id").distinct()
    pairs = pairs.join(rows.select("id", F.col("v").alias("w")), "id").join(rows.where("asked").select(F.col("id").alias("anchor_id"), "v"), "anchor_id")
    return pairs.select("anchor_id", "id", "v", "w").mapInArrow(run, "anchor_id long, id long, score long")


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, bits: int = BITS,
    id_col: str = "vec_id", label_col: str = "label", vec_col: str = "vector",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` holds integer vectors, ``anchors`` is a condition on its columns.  An
    anchor's positives are its ``positives`` best other rows of its label by inner
    product; the negatives of each are the ``negatives`` best rows of other labels whose score is
    from ``low`` to ``high`` per cent of the positive's.
    """
    if not 1 <= bits <= 8:
        raise ValueError("bits: 1 to 8")
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    v = F.col(vec_col).cast("array<long>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v", "asked")).alias("r")).select("id", "r.*")
    rows = written(rows, "vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    if not dims:
        return empty
    rows = rows.where(F.size("v") == dims)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most = None, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), dims)
                least = x.min(0) if least is None else np.minimum(least, x.min(0))
                most = x.max(0) if most is None else np.maximum(most, x.max(0))
        if least is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(least), pa.array(most)], ["d", "low", "high"])

    extremes = rows.select("v").mapInArrow(ends, "d long, low long, high long").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    extremes = extremes.orderBy("d").toPandas()  # one row a dimension
    if max(-extremes["low"].min(), extremes["high"].max()) > LIMIT or dims > 4096:
        raise ValueError(f"components beyond {LIMIT}, or more than 4096 of them: scores would not be exact")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("v").toPandas()  # at most FIT_ROWS
    cells = spark.sparkContext.broadcast(Cells(np.stack(sample["v"].to_list()), extremes["low"].to_numpy(), extremes["high"].to_numpy(), bits))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = cells.value.codes(_matrix(batch.column(2), dims)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "label", "code"])

    nth = F.row_number().over(W.partitionBy("label", "v").orderBy("id"))
    filed = rows.withColumn("nth", nth).where(F.col("nth") <= max(positives + 1, negatives)).select("id", "label", "v")
    file = written(filed.mapInArrow(encode, "id long, label long, code binary"), "cells")
    n_rows = file.count()

    asked = rows.where("asked").select("id", "label", "v")
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("target"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))
    n_asked = asked.count()
    near = _scan(file, asked.withColumn("windows", all_), n_rows, n_asked, cells, dims, True, positives)
    best = W.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = _scored(near, rows, dims).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives)
    found = written(found.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # 50 p <= 100 n <= 95 p, in whole numbers
    least, most = F.ceil(F.col("positive_score") * low / 100), F.floor(F.col("positive_score") * high / 100)
    window = F.struct(F.col("positive_id").alias("target"), least.cast("double").alias("low"), most.cast("double").alias("high"))
    windows = found.where(least <= most).groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(window)).alias("windows"))  # at most ``positives`` each
    open_ = _scan(file, asked.join(windows, "id"), n_rows, n_asked, cells, dims, False, negatives)
    open_ = written(open_, "open")
    got = open_.join(_scored(open_, rows, dims), ["anchor_id", "id"]).withColumnRenamed("target", "positive_id").join(found, ["anchor_id", "positive_id"])
    got = got.where((low * F.col("positive_score") <= 100 * F.col("score")) & (100 * F.col("score") <= high * F.col("positive_score")))
    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    got = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return got.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
