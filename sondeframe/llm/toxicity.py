"""Toxicity: a character n-gram linear classifier with naive-Bayes log-count ratios.

Features are the distinct hashed n-grams (of code points, A-Z lower-cased, runs of
ASCII white space as one space) of a text.  Each feature is scaled by the log ratio of its
smoothed document counts in toxic and other training texts, damped by how sure that ratio is: by
z^2 / (z^2 + DAMP^2), with z its value over its standard error.  Every feature of the training
texts keeps its part, however weak.  A logistic regression with an L2 penalty is
fitted on the scaled features.

Toxic is a score of at least 0.5.  The fit alone would call few documents toxic, as
most labels are clean and weak evidence in a rare language stays below one half; so
its intercept is moved.  Each training row is scored by a model that saw neither the
row nor its copies (``FOLDS`` folds by text), and the
intercept moves until at most ``MAX_FALSE`` of the clean training rows would be
called toxic.  Scores rank as before, but are no probabilities.

The model and those of the folds are fitted by one task each, which reads the
sample's texts batch by batch and keeps their features, at most 96 KB a text; the driver gets the weights, four bytes a bucket, and a number a row.

Only text enters a score.  The fit uses at most ``FIT_ROWS`` labelled rows, drawn
by a hash of the id, with weights that restore the true class shares; everything
else covers whole texts of all rows.

Edge cases: a label whose id several rows hold teaches the smallest of their texts, so
the bound holds for texts too; columns other than id and text play no part and may have any name; null and empty texts score the intercept; very long texts
are hashed in slices of ``SLICE`` bytes, so scratch memory doesn't grow with them; without labelled rows of both
classes every score is the share of toxic labels (0 without labels); folds that leave
one class only are not scored, and without scores of both classes the intercept stays; null labels
and null ids teach nothing; repeated label rows count once for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes, written
from sondeframe.llm.shingles import U64, text_chunks

GRAMS = (4, 6, 8)
BITS = 18
#: Bound of the fit: labelled rows.
FIT_ROWS = 6_000
#: Standard errors at which a log ratio counts by half, its smoothing in toxic rows, and the length of a mean scaled row.
DAMP = 3.0
SMOOTHING = 0.3
SIZE = 2.0
#: Bytes of one text that are hashed at once, and features that a pass of the fit holds in scratch.
SLICE = 1 << 19
PASS = 1 << 20
#: Features of a row beyond which bits take less than four bytes each.
DENSE = (len(GRAMS) << BITS) // 32
#: Folds of the training rows, and the share of clean ones that may score as toxic out of fold.
FOLDS = 5
MAX_FALSE = 0.005
SCHEMA = "doc_id long, score double"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def _buckets(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point; each n has a part of the table of its own."""
    h = np.zeros(len(data) - n + 1, U64)
    for j in range(n):
        h *= U64(0x100000001B3)
        h += data[j : j + len(h)]
    h *= U64(0x9E3779B97F4A7C15)
    h >>= U64(64 - BITS)
    return h.astype(np.int64) + (GRAMS.index(n) << BITS)


def _points(data: np.ndarray) -> np.ndarray:
    """Folded code points of UTF-8 bytes, white space not yet joined."""
    text = data.tobytes().decode("utf-8", "replace").encode("utf-32-le")
    points = np.frombuffer(text, np.uint32)
    return np.where(points < 128, _FOLD[np.minimum(points, 127)], points)


class _Distinct:
    """Distinct values of small-integer arrays by a stamp table, without sorting."""

    def __init__(self) -> None:
        self.stamp = np.zeros(len(GRAMS) << BITS, np.int32)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        at = np.arange(len(values), dtype=np.int32)
        self.stamp[values] = at
        return values[self.stamp[values] == at]


def _sliced(data: np.ndarray) -> list[np.ndarray]:
    """For each n, the distinct buckets of one long text, hashed slice by slice."""
    seen = np.zeros(len(GRAMS) << BITS, bool)
    held, at = np.zeros(0, np.uint32), 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data) and data[end] & 0xC0 == 0x80:  # a code point stays whole
            end += 1
        points = np.concatenate((held, _points(data[at:end])))
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        points = points[keep]
        for n in GRAMS:
            if len(points) >= n:
                seen[_buckets(points.astype(U64), n)] = True
        held, at = points[-(max(GRAMS) - 1) :], end
    return [np.flatnonzero(seen[i << BITS : (i + 1) << BITS]) + (i << BITS) for i in range(len(GRAMS))]


def features(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    """For each n, the distinct buckets of each text."""
    distinct = _Distinct()
    for _, data, offsets in text_chunks(texts):
        if len(offsets) == 2 and len(data) > SLICE:
            yield _sliced(data)
            continue
        begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        offsets = begins[offsets]
        data = _points(data)
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
        inner = offsets[:-1][offsets[:-1] < len(data)]
        keep[inner] = True
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        data = data[keep].astype(U64)
        made = {n: _buckets(data, n) if len(data) >= n else np.zeros(0, np.int64) for n in GRAMS}
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            yield [distinct(made[n][a : max(a, b - n + 1)]) for n in GRAMS]


def _shift(z: np.ndarray, toxic: np.ndarray) -> float:
    """The cut of out-of-fold scores that at most ``MAX_FALSE`` of the clean rows reach, half way to the next toxic one."""
    clean, bad = np.sort(z[toxic == 0])[::-1], np.sort(z[toxic == 1])
    if not len(clean) or not len(bad):
        return 0.0
    last = clean[int(MAX_FALSE * len(clean))]
    above = bad[bad > last]
    return float((last + above[0]) / 2) if len(above) else float(np.nextafter(last, np.inf))


def scales(toxic_rows: np.ndarray, clean_rows: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Damped log ratio of each feature, from how many toxic and clean rows hold it; zero only for equal shares."""
    ratio = np.log((toxic_rows + SMOOTHING) / n_toxic) - np.log(clean_rows / n_clean + SMOOTHING / n_toxic)
    z2 = ratio**2 / (1 / (toxic_rows + 0.5) + 1 / (clean_rows + 0.5))
    return ratio * z2 / (z2 + DAMP**2)


class _Rows:
    """Sorted features of the rows of a sample, held in passes of about ``PASS`` features.

    A feature takes four bytes; a row of more than ``DENSE`` features is kept as a bit for each
    bucket instead, so no row takes more than 96 KB, however long its text is.
    """

    def __init__(self, texts: Iterator[pa.Array]) -> None:
        self.index: list[np.ndarray] = []  # of a row in bits those, else its features
        self.bits: list[bool] = []
        self.passes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, features, their number by row
        held, rows, n = [], [], 0

        def close() -> None:
            whole, sizes = np.concatenate(held), np.array([len(x) for x in held], np.int64)
            for row, e, k in zip(rows, np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
                self.index[row] = whole[e - k : e]
            self.passes.append((np.array(rows), whole, sizes))

        for part in texts:
            for found in features(part):
                own = np.sort(np.concatenate(found).astype(np.int32))  # in order, so that look-ups run through the tables
                self.bits.append(len(own) > DENSE)
                if self.bits[-1]:
                    there = np.zeros(len(GRAMS) << BITS, bool)
                    there[own] = True
                    self.index.append(np.packbits(there))
                    continue
                rows.append(len(self.index))
                self.index.append(own)
                held.append(own)
                n += len(own)
                if n >= PASS:
                    close()
                    held, rows, n = [], [], 0
        if held:
            close()

    def of(self, row: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.index[row])) if self.bits[row] else self.index[row]

    def sums(self, use: np.ndarray, of_feature: np.ndarray) -> np.ndarray:
        """For each row in ``use`` the sum of its features' values."""
        return np.array([of_feature.take(self.of(i)).sum(dtype=np.float64) for i in use])

    def gathered(self, of_row: np.ndarray, size: int) -> np.ndarray:
        """For each feature the sum of its rows' values."""
        out = np.zeros(size)
        for rows, whole, sizes in self.passes:
            if of_row[rows].any():
                out += np.bincount(whole, np.repeat(of_row[rows], sizes), size)
        for row in np.flatnonzero(self.bits):
            if of_row[row]:
                out[self.of(row)] += of_row[row]
        return out


def _logistic(rows: _Rows, use: np.ndarray, scale: np.ndarray, toxic: np.ndarray, weight: np.ndarray, l2: float, rounds: int) -> tuple[float, np.ndarray]:
    """Adam on the weighted logistic loss of the rows ``use`` with an L2 penalty; intercept and weights of scaled features."""
    total, share = weight[use].sum(), (toxic[use] * weight[use]).sum() / weight[use].sum()
    w, b = np.zeros(len(scale)), float(np.log(share / (1 - share)))
    m = v = np.zeros(len(scale) + 1)
    for t in range(1, rounds + 1):
        z = b + rows.sums(use, (scale * w).astype(np.float32))
        err = np.zeros(len(toxic))
        err[use] = weight[use] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[use])
        g = np.append(l2 * w + scale * rows.gathered(err, len(scale)), err.sum()) / total
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - float(step[-1])
    return b, w


def _fitted(rows: _Rows, use: np.ndarray, toxic: np.ndarray, weight: np.ndarray, l2: float, rounds: int) -> tuple[float, np.ndarray]:
    """Intercept and a weight for each bucket, from the rows ``use``."""
    size = len(GRAMS) << BITS
    there = np.zeros((2, len(toxic)))
    there[toxic[use].astype(int), use] = 1.0
    clean, bad = (rows.gathered(x, size) for x in there)
    scale = scales(bad, clean, there[1].sum(), there[0].sum())
    length = rows.sums(use, (scale**2).astype(np.float32)).mean()
    scale *= SIZE / np.sqrt(max(length, 1e-12))
    b, w = _logistic(rows, use, scale, toxic, weight, l2, rounds)
    return b, w * scale


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit_rows: int) -> DataFrame:
    """``(text, toxic, weight, fold)``: at most ``fit_rows`` labelled rows that are not held out, half of each class at most."""
    labels = labels.select(F.col(id_col).cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    labels = labels.where(F.col("toxic").isin(0, 1) & F.coalesce(~held_out(F.col("_id")), F.lit(False)))
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    parts = []
    for kind, n in sorted(sizes.items()):
        take = min(n, max(fit_rows // 2, fit_rows - sizes.get(1 - kind, 0)))
        part = labels.where(F.col("toxic") == kind).orderBy(F.xxhash64("_id"), "_id").limit(take)
        parts.append(part.withColumn("weight", F.lit(n / take)))
    if not parts:
        return docs.sparkSession.createDataFrame([], "text string, toxic int, weight double, fold int")
    chosen = written(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # At most fit_rows ids, a proven bound for the broadcasts, and one text for each of them.
    texts = texts.join(F.broadcast(chosen.select("_id").distinct()), "_id").groupBy("_id").agg(F.min("text").alias("text"))
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    return written(texts.join(F.broadcast(chosen), "_id").select("text", "toxic", "weight", fold), "sample")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS,
    l2: float = 0.05, rounds: int = 40,
) -> tuple[float, np.ndarray]:
    """Intercept and a weight for each bucket.

    The sample (at most ``fit_rows`` texts) goes to one task for each model: that of all its
    rows, and one for each fold left out, which scores the rows of its fold.
    """
    table = np.zeros(len(GRAMS) << BITS)
    sampled = sample(docs, labels, id_col, text_col, fit_rows)
    found = sampled.groupBy("toxic", "fold").agg(F.count("*").alias("n"), F.max("weight").alias("weight")).collect()
    sizes, weight = np.zeros((2, FOLDS)), np.ones(2)  # the weight is one for each class
    for r in found:
        sizes[r["toxic"], r["fold"]], weight[r["toxic"]] = r["n"], r["weight"]
    totals = weight * sizes.sum(1)
    if not totals.all():
        share = min(max(1.0 if totals[1] else 0.0, 1e-9), 1 - 1e-9)
        return float(np.log(share / (1 - share))), table

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # all but the texts, of which a batch is there at a time

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                held.append(batch.select(["model", "toxic", "weight", "fold"]))
                yield from (x.column("text") for x in by_bytes([batch], 1))

        rows = _Rows(texts())
        data = pa.Table.from_batches(held)
        out = data.column("model")[0].as_py()
        toxic, weights, folds = (data.column(c).to_numpy() for c in ("toxic", "weight", "fold"))
        toxic = toxic.astype(float)
        b, w = _fitted(rows, np.flatnonzero(folds != out), toxic, weights, l2, rounds)
        own = np.flatnonzero(folds == out)
        z = b + rows.sums(own, w.astype(np.float32)) if len(own) else np.zeros(0)
        weights_ = w.astype(np.float32).tobytes() if out < 0 else b""
        yield pa.RecordBatch.from_pydict({"model": pa.array([out], pa.int32()), "b": pa.array([b], pa.float64()), "w": pa.array([weights_], pa.binary()), "z": pa.array([z.tolist()], pa.list_(pa.float64())), "toxic": pa.array([toxic[own].tolist()], pa.list_(pa.float64()))})

    scored = [k for k in range(FOLDS) if sizes[:, k].any() and (sizes.sum(1) > sizes[:, k]).all()]
    models = F.explode(F.array(*[F.lit(k) for k in (-1, *scored)])).alias("model")
    jobs = sampled.select(models, "text", "toxic", "weight", "fold").repartition(FOLDS + 1, "model").groupBy("model")
    made = jobs.applyInArrow(train, "model int, b double, w binary, z array<double>, toxic array<double>").collect()  # FOLDS + 1 rows
    z = np.array([x for r in made for x in r["z"]])
    toxic = np.array([x for r in made for x in r["toxic"]])
    (whole,) = (r for r in made if r["model"] < 0)
    return whole["b"] - _shift(z, toxic), np.frombuffer(whole["w"], np.float32).astype(float)


def score(docs: DataFrame, model: tuple[float, np.ndarray], text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or only its ``carry`` columns) with a ``_score`` of 0 to 1 appended."""
    b = model[0]
    shared = docs.sparkSession.sparkContext.broadcast(model[1].astype(np.float32))  # 4 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            z = [b + sum(float(table[x].sum(dtype=np.float64)) for x in found) for found in features(batch.column(batch.num_columns - 1))]
            scores = 1 / (1 + np.exp(-np.clip(np.array(z), -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "_score"])

    held = docs.select(*[F.col(f"`{c}`") for c in (carry or docs.columns)])
    schema = held.schema.simpleString()  # struct<...>
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in held.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    out = source.mapInArrow(run, f"row {schema}, _score double")
    return out.select("row.*", "_score")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each document."""
    model = fit(docs, labels, id_col, text_col, fit_rows)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return score(source, model, "_text", carry=["doc_id"]).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("_score").alias("score"),
                    (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    return score(docs, fit(train_docs, labels, fit_rows=fit_rows)).where("_score < 0.5").select(*[F.col(f"`{c}`") for c in docs.columns])
