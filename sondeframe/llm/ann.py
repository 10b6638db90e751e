"""Approximate nearest neighbours for maximum inner product.

Vectors are dealt to coarse cells and their residuals quantised to four bits for
each pair of dimensions.  Codebooks and codes minimise a score-aware loss: with
e = x - x~, the part of e along x counts ``eta`` times the orthogonal part, since it
is what changes large inner products.  A query scans the codes of its best cells
with lookup tables and the best ``rerank`` of each block are scored exactly.

Cells and codebooks are fitted on at most ``FIT_ROWS`` vectors; every vector is
indexed.  The number of cells grows with the rows, one for about ``CELL_ROWS``: a
cell is a first centre and, beyond what the sample can place, a second one for the
residual.  The true neighbours of ``ASKED`` sampled queries among all rows (one exact
pass, linear in the rows) set the number of cells probed first: the smallest that holds
``COVERAGE`` of them.  A query whose cells hold too few vectors for its neighbours
probes more of them.

Nothing rests on the sample: each row's distance to its code is kept, so its score has an upper
bound, and rows whose bound reaches the block's last place are scored exactly too.  A cell
has a bound by its radius and its longest vector; cells whose bound reaches a query's last place of the
first pass are scanned in a second one.  Rows without clusters leave most cells open.  Cells are packed in blocks of about ``BLOCK_ROWS`` vectors and
queries in blocks of ``QUERY_ROWS``, so a crowded cell is many small tasks; a task
merges what its cells give for one query before the shuffle.

Edge cases: vectors that are null, zero, of another length than most, or hold null
or non-finite components take no part; ties go to the smaller id; queries without
any candidate give no rows; repeated ids are separate candidates, never of themselves,
and ask once; columns other than those named are read by ``queries`` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe.llm.common import written

FIT_ROWS = 20_000
CELL_ROWS = 1_024
MAX_CENTRES = 1_024  # on each of the two levels
ASKED = 256
COVERAGE = 0.985
BLOCK_ROWS = 8_192
QUERY_ROWS = 512
KEPT_ROWS = 500_000  # found rows that a task holds
SUB = 2  # dimensions a code
CODES = 16  # four bits
THRESHOLD = 0.2
PAIRS = 1 << 15  # pairs scored at once
SLACK = 1e-5  # of the vectors' lengths, for rounding in tables of four-byte numbers


class Model:
    """Two levels of centres, codebooks (parts, 16, SUB), the loss weight, rows by cell and the cells to probe."""

    def __init__(self, first: np.ndarray, second: np.ndarray, books: np.ndarray, eta: float) -> None:
        self.first, self.second, self.books, self.eta = first, second, books, eta
        self.size = len(first) * len(second)
        self.held, self.probe = np.ones(self.size, np.int64), self.size

    def cells(self, x: np.ndarray) -> np.ndarray:
        a = _closest(x, self.first)
        return a * len(self.second) + _closest(x - self.first[a], self.second)

    def centres(self, cells: np.ndarray) -> np.ndarray:
        return self.first[cells // len(self.second)] + self.second[cells % len(self.second)]

    def scores(self, q: np.ndarray) -> np.ndarray:
        """(queries, cells): inner products with the cells' centres; an empty cell has -inf."""
        s = ((q @ self.first.T)[:, :, None] + (q @ self.second.T)[:, None, :]).reshape(len(q), -1)
        return np.where(self.held > 0, s, -np.inf)

    def probes(self, q: np.ndarray, need: np.ndarray) -> list[list[int]]:
        """The best cells of each query: ``probe`` of them, and more until they hold ``need`` vectors."""
        out: list[list[int]] = []
        step = max(1, (4 << 20) // self.size)
        for at in range(0, len(q), step):
            s, p = self.scores(q[at : at + step]), min(self.probe, self.size)
            while True:
                best = np.argpartition(-s, p - 1, axis=1)[:, :p]
                best = np.take_along_axis(best, np.argsort(-np.take_along_axis(s, best, 1), axis=1, kind="stable"), 1)
                sums = np.cumsum(self.held[best], axis=1)
                if p == self.size or (sums[:, -1] >= need[at : at + step]).all():
                    break
                p = min(2 * p, self.size)
            enough = (sums < need[at : at + step, None]).sum(1) + 1
            out += [row[: max(self.probe, n)].tolist() for row, n in zip(best, enough.tolist(), strict=True)]
        return out

    def calibrate(self, q: np.ndarray, of: np.ndarray, near: np.ndarray, coverage: float) -> None:
        """Probe as many cells as hold ``coverage`` of the true neighbours: ``near`` is a cell, ``of`` its query in ``q``."""
        places = np.zeros(len(of), np.int64)
        for i in np.unique(of):
            s, mine = self.scores(q[i : i + 1])[0], of == i
            places[mine] = len(s) - np.searchsorted(np.sort(s), s[near[mine]], side="left")
        if len(places):
            self.probe = int(min(self.size, np.quantile(places, coverage, method="higher")))

    def encode(self, x: np.ndarray, cells: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """(n, parts) codes by coordinate descent on the score-aware loss."""
        t = _pad(x - self.centres(cells)).reshape(len(x), -1, SUB)
        u = _pad(x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(len(x), -1, SUB)
        return _assign(t, u, self.books, self.eta, None, sweeps)

    def errors(self, x: np.ndarray, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distance of each vector to what its codes stand for."""
        t = _pad(x - self.centres(cells)).reshape(len(x), -1, SUB)
        return np.sqrt(sum(((t[:, m] - self.books[m][codes[:, m]]) ** 2).sum(1) for m in range(t.shape[1])))

    def open_cells(self, q: np.ndarray, least: np.ndarray, done: list, radius: np.ndarray, norm: np.ndarray) -> list[list[int]]:
        """For each query the cells beside ``done`` that may hold a score of ``least``; ``radius`` and ``norm`` are the cells' largest."""
        out = []
        for row, low, probed in zip(q, least, done, strict=True):
            long = np.linalg.norm(row)
            reach = np.minimum(self.scores(row[None])[0] + long * radius, long * norm)
            # Not below, rather than above: a bound that is no number leaves its cell open.
            there = (self.held > 0) & ~(reach + SLACK * long * (norm + radius) < low)
            there[np.asarray(probed, np.int64)] = False
            out.append(np.flatnonzero(there).tolist())
        return out

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(queries, bytes, 256): a lookup table for each pair of four-bit codes."""
        part = np.einsum("qms,mks->qmk", _pad(q).reshape(len(q), -1, SUB), self.books)
        if part.shape[1] % 2:
            part = np.concatenate((part, np.zeros_like(part[:, :1])), axis=1)
        low, high = part[:, 0::2], part[:, 1::2]
        return (high[:, :, :, None] + low[:, :, None, :]).reshape(len(q), -1, 256).astype(np.float32)


def _pad(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, -x.shape[1] % SUB)))


def pack_codes(codes: np.ndarray) -> np.ndarray:
    """Two four-bit codes a byte, the first in the low half."""
    if codes.shape[1] % 2:
        codes = np.pad(codes, ((0, 0), (0, 1)))
    return (codes[:, 0::2] | codes[:, 1::2] << 4).astype(np.uint8)


def _assign(t: np.ndarray, u: np.ndarray, books: np.ndarray, eta: float, codes: np.ndarray | None, sweeps: int) -> np.ndarray:
    n, parts, _ = t.shape
    rows = np.arange(n)
    if codes is None:
        codes = np.stack([((t[:, m, None, :] - books[m]) ** 2).sum(2).argmin(1) for m in range(parts)], axis=1).astype(np.uint8)
    along = sum((( t[:, m] - books[m][codes[:, m]]) * u[:, m]).sum(1) for m in range(parts))
    for _ in range(sweeps):
        for m in range(parts):
            e = t[:, m, None, :] - books[m]
            par = (e * u[:, m, None, :]).sum(2)
            rest = along - par[rows, codes[:, m]]
            codes[:, m] = ((e * e).sum(2) + (eta - 1) * (rest[:, None] + par) ** 2).argmin(1)
            along = rest + par[rows, codes[:, m]]
    return codes


def _closest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    norms = (c * c).sum(1)[None, :]
    parts = [np.argmin(norms - 2 * x[at : at + 2048] @ c.T, axis=1) for at in range(0, len(x), 2048)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _products(x: np.ndarray, q: np.ndarray, of: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Inner product of the pairs ``(q[of], x[place])``, alike for equal vectors whatever the others are."""
    parts = [np.einsum("nd,nd->n", x[place[at : at + PAIRS]], q[of[at : at + PAIRS]]) for at in range(0, len(of), PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _largest(scores: np.ndarray, m: int) -> np.ndarray:
    """(queries, m): the places of the ``m`` largest of each row, rising; of equal ones the first."""
    least = np.partition(scores, scores.shape[1] - m, axis=1)[:, scores.shape[1] - m, None]
    more, equal = scores > least, scores == least
    equal &= np.cumsum(equal, axis=1) <= m - more.sum(1, keepdims=True)
    return np.nonzero(more | equal)[1].reshape(len(scores), m)


def _best(found: list[pd.DataFrame], top: int) -> pd.DataFrame:
    """The ``top`` rows of each query: largest scores, ties to the smaller id."""
    rows = pd.concat(found).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return rows[rows.groupby("query_id").cumcount() < top]


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        a = _closest(x, c)
        n = np.bincount(a, minlength=k)
        sums = np.stack([np.bincount(a, x[:, d], k) for d in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), k)])
    return c


def fit(x: np.ndarray, rows: int, rounds: int = 4, seed: int = 7) -> Model:
    """Fit cells for ``rows`` vectors and codebooks on a sample of them."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    want = max(1, rows // CELL_ROWS)
    first = _kmeans(x, max(1, min(want, MAX_CENTRES, n // 20)), rng)
    left = x - first[_closest(x, first)]
    k2 = min(MAX_CENTRES, -(-want // len(first)))
    second = np.zeros((1, d)) if k2 == 1 or want <= len(first) or n < 20 * k2 else _kmeans(left, k2, rng)
    eta = max(1.0, (d - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))
    model = Model(first, second, np.zeros(0), eta)
    t = _pad(x - model.centres(model.cells(x)))
    t = t.reshape(n, -1, SUB)
    u = _pad(x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(n, -1, SUB)
    books = np.stack([_kmeans(t[:, m], CODES, rng, 8) for m in range(t.shape[1])])
    codes = _assign(t, u, books, eta, None, 1)
    for _ in range(rounds):
        along = sum(((t[:, m] - books[m][codes[:, m]]) * u[:, m]).sum(1) for m in range(t.shape[1]))
        for m in range(t.shape[1]):
            # least squares for each centre: (n I + (eta-1) sum uu') c = sum t + (eta-1) sum u (rest + t.u)
            a, um, tm = codes[:, m], u[:, m], t[:, m]
            rest = along - ((tm - books[m][a]) * um).sum(1)
            left = np.bincount(a, minlength=CODES)[:, None, None] * np.eye(SUB) + 1e-9 * np.eye(SUB)
            right = np.stack([np.bincount(a, tm[:, s] + (eta - 1) * um[:, s] * (rest + (tm * um).sum(1)), CODES) for s in range(SUB)], axis=1)
            for i in range(SUB):
                for j in range(SUB):
                    left[:, i, j] += (eta - 1) * np.bincount(a, um[:, i] * um[:, j], CODES)
            new = np.linalg.solve(left, right[:, :, None])[:, :, 0]
            books[m] = np.where(np.bincount(a, minlength=CODES)[:, None] > 0, new, books[m])
            along = rest + ((tm - books[m][a]) * um).sum(1)
        codes = _assign(t, u, books, eta, codes, 1)
    model.books = books
    return model


def valid(v: Column, dims: int) -> Column:
    ok = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return v.isNotNull() & (F.size(v) == dims) & ok & F.exists(v, lambda c: c != 0)


def nearest(
    vectors: DataFrame, queries: Column, top: int = 20, rerank: int = 200, id_col: str = "vec_id", vec_col: str = "embedding",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` rows of largest inner product for each row of ``queries``.

    ``queries`` is a condition on the columns of ``vectors``; every valid row is a
    candidate, but not a query's own id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = rows.where("vec_id is not null")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    common = rows.where("v is not null").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None or common["d"] == 0:
        return empty
    rows = rows.where(valid(F.col("v"), common["d"]))
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).select("vec_id", "v").toPandas()  # at most fit_rows
    if len(sample) == 0:
        return empty
    known = np.stack(sample["v"].to_list())
    model = fit(known, total)
    shared = spark.sparkContext.broadcast(model)  # centres and codebooks: fixed size

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"].to_list())
                cells = model.cells(x)
                codes = model.encode(x, cells)
                sizes = {"err": model.errors(x, cells, codes), "radius": np.linalg.norm(x - model.centres(cells), axis=1), "norm": np.linalg.norm(x, axis=1)}
                packed_codes = [c.tobytes() for c in pack_codes(codes)]
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "cell": cells, "code": packed_codes, "v": [r.tobytes() for r in x], "q": pdf["q"], **sizes})

    indexed = written(rows.mapInPandas(index, "vec_id long, cell int, code binary, v binary, q boolean, err double, radius double, norm double"), "indexed")
    held = indexed.groupBy("cell").agg(F.count("*").alias("count"), F.max("radius").alias("radius"), F.max("norm").alias("norm")).toPandas()  # at most one row a cell
    model.held = np.bincount(held["cell"], held["count"], model.size).astype(np.int64)
    radius, norm = (np.bincount(held["cell"], held[c], model.size) for c in ("radius", "norm"))
    first = indexed.where("q").orderBy(F.xxhash64("vec_id"), "vec_id").limit(ASKED).select("vec_id", "v").toPandas()
    if len(first) == 0:
        return empty
    asked_ids, asked_v = first["vec_id"].to_numpy(), np.stack([np.frombuffer(v) for v in first["v"]])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The best ``top`` of the partition for each sampled vector, by scores on whole vectors."""
        best = np.full((len(asked_v), top), -np.inf)
        cells = np.zeros((len(asked_v), top), np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 2048):
                part = pdf.iloc[at : at + 2048]
                x = np.frombuffer(b"".join(part["v"])).reshape(len(part), -1)
                s = asked_v @ x.T
                s[asked_ids[:, None] == part["vec_id"].to_numpy()[None, :]] = -np.inf
                s = np.concatenate((best, s), axis=1)
                c = np.concatenate((cells, np.broadcast_to(part["cell"].to_numpy(), (len(asked_v), len(part)))), axis=1)
                keep = np.argpartition(-s, top - 1, axis=1)[:, :top]
                best, cells = np.take_along_axis(s, keep, 1), np.take_along_axis(c, keep, 1)
        of = np.repeat(np.arange(len(asked_v)), top)
        found = np.isfinite(best.ravel())
        yield pd.DataFrame({"of": of[found], "cell": cells.ravel()[found], "score": best.ravel()[found]})

    near = indexed.select("vec_id", "cell", "v").mapInPandas(exact, "of int, cell int, score double")
    near = near.withColumn("place", F.row_number().over(W.partitionBy("of").orderBy(F.desc("score"), "cell")))
    near = near.where(F.col("place") <= top).toPandas()  # ASKED x top rows
    model.calibrate(asked_v, near["of"].to_numpy(), near["cell"].to_numpy(), COVERAGE)
    probing = spark.sparkContext.broadcast(model)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.frombuffer(b"".join(pdf["v"])).reshape(len(pdf), -1)
                yield pdf[["vec_id", "v"]].assign(probes=probing.value.probes(x, pdf["own"].to_numpy() + top))

    # A query id that several rows hold is asked once, by the smallest of its vectors (as bytes).
    queries_ = indexed.groupBy("vec_id").agg(F.min(F.when(F.col("q"), F.col("v"))).alias("v"), F.count("*").alias("own")).where("v is not null")
    queries_ = written(queries_.mapInPandas(probe, "vec_id long, v binary, probes array<int>"), "asked")

    def more(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.frombuffer(b"".join(pdf["v"])).reshape(len(pdf), -1)
                yield pdf[["vec_id", "v", "least"]].assign(probes=probing.value.open_cells(x, pdf["least"].to_numpy(), pdf["probes"].to_list(), radius, norm))

    def packed(part: DataFrame, size: int, names: list[str]) -> DataFrame:
        """One row for each block of a cell: ids and arrays as bytes; blocks are dealt by a hash of the id."""
        counts = part.groupBy("cell").count()  # at most one row a cell
        blocks = F.ceil(F.col("count") / size)
        part = part.join(F.broadcast(counts), "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
        folded = part.groupBy("cell", "block").agg(F.sort_array(F.collect_list(F.struct("vec_id", *names))).alias("rows"))
        return folded.select("cell", *[F.col(f"rows.{n}").alias(n) for n in ("vec_id", *names)])

    candidates = packed(indexed.select("vec_id", "cell", "code", "v", "err"), BLOCK_ROWS, ["code", "v", "err"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        out: list[pd.DataFrame] = []
        n = 0
        for pdf in batches:
            for cell, ids, code, v, err, qid, qv, low in pdf[["cell", "vec_id", "code", "v", "err", "qid", "qv", "least"]].itertuples(index=False):
                ids, qid, err, low = np.asarray(ids), np.asarray(qid), np.asarray(err), np.asarray(low)
                x = np.frombuffer(b"".join(v)).reshape(len(ids), -1)
                centre = model.centres(np.array([cell]))[0]
                longest = np.linalg.norm(x, axis=1).max() + np.linalg.norm(centre)
                codes = np.frombuffer(b"".join(code), np.uint8).reshape(len(ids), -1).T.astype(np.intp)
                for at in range(0, len(qid), 64):
                    q = np.frombuffer(b"".join(qv[at : at + 64])).reshape(-1, x.shape[1])
                    tables = model.tables(q)
                    approx = np.zeros((len(q), len(ids)), np.float32)
                    for b in range(len(codes)):
                        approx += np.take(tables[:, b], codes[b], axis=1)
                    own = qid[at : at + 64, None]
                    ranked_ = approx if np.isfinite(approx).all() else np.nan_to_num(approx)
                    take = _largest(ranked_, min(rerank + 1, len(ids)))
                    exact_ = np.full(approx.shape, -np.inf)
                    of = np.repeat(np.arange(len(q)), take.shape[1])
                    exact_[of, take.ravel()] = _products(x, q, of, take.ravel())
                    exact_[ids[None, :] == own] = -np.inf
                    # The last place so far, of this block or of the pass before.
                    best = np.take_along_axis(exact_, take, 1)
                    last = low[at : at + 64]
                    if best.shape[1] >= top:
                        last = np.maximum(last, np.partition(best, best.shape[1] - top, axis=1)[:, best.shape[1] - top])
                    if take.shape[1] < len(ids):
                        # Rows whose bound reaches it; those that a product shows to stay below are left.
                        long = np.linalg.norm(q, axis=1)
                        slack = SLACK * long * longest
                        bound = approx + (q @ centre + slack)[:, None] + long[:, None] * err[None, :]
                        rest = ~(bound < last[:, None]) & (ids[None, :] != own)
                        rest[of, take.ravel()] = False
                        rest &= ~(q @ x.T < (last - slack)[:, None])
                        of, place = np.nonzero(rest)
                        exact_[of, place] = _products(x, q, of, place)
                    of, place = np.nonzero((exact_ >= last[:, None]) & np.isfinite(exact_))
                    out.append(_best([pd.DataFrame({"query_id": qid[at : at + 64][of], "vec_id": ids[place], "score": exact_[of, place]})], top))
                n += len(qid) * top
                if n > KEPT_ROWS:  # a query's cells in this task merge; what is left of too many queries is sent on
                    out = [_best(out, top)]
                    n = len(out[0])
                    if n > KEPT_ROWS // 2:
                        yield out[0]
                        out, n = [], 0
        if out:
            yield _best(out, top)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def scanned(cells: DataFrame) -> DataFrame:
        """The rows that ``(vec_id, v, least, probes)`` find in their ``probes``."""
        asked = packed(cells.select("vec_id", F.explode("probes").alias("cell"), "v", "least"), QUERY_ROWS, ["v", "least"])
        asked = asked.select("cell", F.col("vec_id").alias("qid"), F.col("v").alias("qv"), "least")
        pairs = candidates.join(asked, "cell").repartition(tasks, "cell", F.element_at("vec_id", 1), F.element_at("qid", 1))
        return pairs.select("cell", "vec_id", "code", "v", "err", "qid", "qv", "least").mapInPandas(scan, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    none = F.lit(float("-inf"))
    found = written(ranked(scanned(queries_.withColumn("least", none))), "found")
    lasts = found.where(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    open_ = queries_.join(lasts, "vec_id", "left").withColumn("least", F.coalesce("least", none))
    open_ = written(open_.mapInPandas(more, "vec_id long, v binary, least double, probes array<int>").where(F.size("probes") > 0), "open")
    if not open_.isEmpty():
        found = ranked(found.drop("rank").unionByName(scanned(open_)))
    return found.select("query_id", "rank", "vec_id", "score")
