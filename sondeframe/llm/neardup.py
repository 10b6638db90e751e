"""MinHash near-duplicate grouping: SuperMinHash, banding, exact verification, union-find.

Plan
  1. One pass over the texts writes, for each document, its set size, a 128-bit
     fingerprint of its whole shingle set and one hash for each band.
  2. Equal sets collapse to one class, a node (partial minimum, so thousands of
     copies cost one row), and only these nodes go on.
  3. Nodes sharing a band bucket are candidates.  Buckets of at most
     ``SMALL_BUCKET`` give their pairs.  A larger bucket gives a star from its
     smallest member only; members that the star leaves in different components
     go through an exact prefix join (below), never through all pairs.
  4. Candidates are confirmed on full sets; confirmed links are grouped.

The prefix join orders the elements of these members by how many of them hold
each, rare first.  Edits are rare, so thousands of distant copies of one text have
few partners, and no link is lost (``_prefix_pairs``).

Edge cases: null or empty texts have no set, link with nothing and are kept; rows
with a null id are passed through with a null component and kept; repeated rows
are equal sets of one id; rows sharing an id but not a text are nodes of their own,
linked with each other, in whatever order they come.  Extra columns do not matter: only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes, limited_broadcast, written
from sondeframe.llm.components import connected_components
from sondeframe.llm.shingles import U64, distinct_sets, mix64
from sondeframe.llm.superminhash import band_hashes, signatures

SMALL_BUCKET = 16
#: Parts in which the partners of one node are checked when their number is not known beforehand.
SALTS = 64
#: Candidate ids up to this count (8 bytes each) are broadcast when texts are fetched; beyond it, a shuffle join.
BROADCAST_IDS = 500_000


def _fingerprints(elements: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each whole set."""
    out = []
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix64(elements ^ U64(salt)), dtype=U64)))
        out.append(mix64(sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def sketch(docs: DataFrame, shingle: int, bands: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, fp1, fp2, bands``: one row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, elements, offsets in distinct_sets(batch.column(1), shingle):
                n = len(offsets) - 1
                fp1, fp2 = _fingerprints(elements, offsets)
                hashes = band_hashes(signatures(elements, offsets, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(np.arange(0, (n + 1) * bands, bands, dtype=np.int32), hashes.ravel())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, n), pa.array(np.diff(offsets), pa.int64()), pa.array(fp1), pa.array(fp2), lists],
                    ["id", "n_shingles", "fp1", "fp2", "bands"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "id long, n_shingles long, fp1 long, fp2 long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b, salt)`` whose full sets have den * |a & b| >= num * |a | b|, as ``(u, v)``.

    The text of ``a`` is sent once for each salt, ahead of its partners of that salt, so a
    node of thousands of partners is spread over tasks and no pair carries two texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.zeros(0, U64)
        for batch in by_bytes(batches, 2):
            a, b = batch.column(0), batch.column(1)
            partner, good = b.is_valid().to_numpy(zero_copy_only=False), np.zeros(batch.num_rows, bool)
            for row, elements, offsets in distinct_sets(batch.column(2), shingle):
                for i in range(len(offsets) - 1):
                    own = elements[offsets[i] : offsets[i + 1]]
                    if not partner[row + i]:
                        centre = own.copy()
                        continue
                    p, q = len(centre), len(own)
                    if p and q and den * min(p, q) >= num * max(p, q):
                        both = p + q - len(np.union1d(centre, own))
                        good[row + i] = den * both >= num * (p + q - both)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(good)), b.filter(pa.array(good))], ["u", "v"])

    partners = pairs.join(texts.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "text")
    centres = pairs.select("a", "salt").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    both = centres.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return both.select("a", "b", "text").mapInArrow(run, "u long, v long")


def _told(rows: DataFrame, shingle: int) -> DataFrame:
    """``(id, text, n_shingles, fp1, fp2)`` of ``rows(id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, elements, offsets in distinct_sets(batch.column(1), shingle):
                n = len(offsets) - 1
                fp1, fp2 = _fingerprints(elements, offsets)
                columns = [*(c.slice(row, n) for c in batch.columns), pa.array(np.diff(offsets), pa.int64()), pa.array(fp1), pa.array(fp2)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text", "n_shingles", "fp1", "fp2"])

    return rows.select("id", "text").mapInArrow(run, "id long, text string, n_shingles long, fp1 long, fp2 long")


def _elements(docs: DataFrame, shingle: int) -> DataFrame:
    """``(x, n, token)``: every element of the sets of ``docs(x, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, elements, offsets in distinct_sets(batch.column(1), shingle):
                sizes = np.diff(offsets)
                x = batch.column(0).slice(row, len(sizes)).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays(
                    [x, pa.array(np.repeat(sizes, sizes)), pa.array(elements.view(np.int64))], ["x", "n", "token"]
                )

    return docs.select("x", "text").mapInArrow(run, "x long, n long, token long")


def _prefix_pairs(open_: DataFrame, texts: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``open_(x, component)`` between components that may reach num / den.

    Prefix and positional filters of set similarity joins: elements are ordered by
    (documents that hold them, hash), rare first.  A pair's first common element
    lies in the longer set's first n - ceil(t n) + 1 and in the shorter set's first
    n - ceil(2 t / (1 + t) n) + 1 elements, and what follows it must still suffice.
    Elements held by one document only count as positions and never join.
    """
    found = _elements(open_.join(texts.withColumnRenamed("node", "x"), "x"), shingle)
    found = written(found.distinct().join(open_, "x"), "elements")
    held = found.groupBy("token").agg(F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    shared = found.join(held.where("df > 1"), "token")
    of_x = W.partitionBy("x")
    at = F.col("n") - F.count("*").over(of_x) + F.row_number().over(of_x.orderBy("df", "token"))
    n = F.col("n")
    upto = lambda p, q: n - F.ceil(F.lit(p) * n / F.lit(q) - F.lit(1e-9)) + 1
    shared = shared.withColumn("at", at).withColumn("index", F.col("at") <= upto(2 * num, num + den))
    shared = written(shared.where((F.col("at") <= upto(num, den)) & (F.col("lo") != F.col("hi"))).select("token", "x", "n", "component", "at", "index"), "prefix")
    one = shared.where("index").select("token", F.col("x").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("at").alias("ia"))
    two = shared.select("token", F.col("x").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("at").alias("ib"))
    fits = F.expr(
        f"ca <> cb and (na < nb or (na = nb and a < b)) and {den} * na >= {num} * nb "
        f"and {num + den} * (1 + least(na - ia, nb - ib)) >= {num} * (na + nb)"
    )
    return one.join(two, "token").where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, bands: int = 32, rows: int = 5,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Group documents whose shingle sets have Jaccard similarity of at least num / den.

    Returns ``(id, n_shingles, component_id, kept)``, one row for each input row.
    With 32 bands of 5 rows a pair at 0.80 is missed with probability 3e-6, one at
    0.85 with 7e-9; every pair that meets in a band is decided exactly.
    """
    sketches = written(sketch(docs, shingle, bands, rows, id_col, text_col), "sketch")
    held = sketches.where("n_shingles > 0 and id is not null")
    key = ["fp1", "fp2", "n_shingles"]
    classes = held.groupBy(*key).agg(F.min("id").alias("rep")).withColumn("node", F.monotonically_increasing_id())
    classes = written(classes, "classes")  # from here on a node's number is fixed
    firsts = held.join(classes, key).where("id = rep")
    slots = firsts.select("node", "rep", F.posexplode("bands").alias("band", "hash")).distinct()
    # A bucket's centre is its member of smallest id: copies mostly come after what they copy.
    stats = slots.groupBy("band", "hash").agg(F.count("*").alias("n"), F.min(F.struct("rep", "node")).alias("c")).where("n > 1")
    buckets = written(slots.join(stats.withColumn("c", F.col("c.node")), ["band", "hash"]).drop("rep"), "buckets")

    small = buckets.where(F.col("n") <= SMALL_BUCKET)
    small = small.groupBy("band", "hash").agg(F.sort_array(F.collect_list("node")).alias("m"))  # at most SMALL_BUCKET each
    small = small.select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b"), F.lit(0).cast("long").alias("salt")).where("a < b")
    away = (F.col("n") > SMALL_BUCKET) & (F.col("node") != F.col("c"))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / SMALL_BUCKET))
    stars = buckets.where(away).select(F.col("c").alias("a"), F.col("node").alias("b"), salt.alias("salt"))
    pairs = written(small.unionByName(stars).groupBy("a", "b").agg(F.max("salt").alias("salt")), "pairs")

    # Ids that hold several texts: their classes belong together, and a text of theirs is told by its fingerprint.
    one = F.struct(*key)
    several = written(held.groupBy("id").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).where("lo <> hi").select("id"), "several")
    shared = not several.isEmpty()
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = written(wanted.join(classes, "node").withColumnRenamed("rep", "id"), "wanted")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = source.join(limited_broadcast(wanted.select("id").distinct(), BROADCAST_IDS), "id")
    single = found.join(several, "id", "left_anti").dropDuplicates(["id"]) if shared else found.dropDuplicates(["id"])
    texts = single.join(wanted.select("id", "node"), "id").select("node", "text")
    if shared:
        told = _told(found.join(several, "id", "left_semi"), shingle).join(wanted, ["id", *key]).dropDuplicates(["node"])
        texts = texts.unionByName(told.select("node", "text"))
    texts = written(texts, "texts")
    links = _verified(pairs, texts, shingle, num, den)
    if shared:
        of = held.join(several, "id", "left_semi").select("id", *key).distinct().join(classes, key).select("id", "node")
        links = links.unionByName(of.join(of.groupBy("id").agg(F.min("node").alias("u")), "id").select("u", F.col("node").alias("v")).where("u <> v"))
    links = written(links, "links")
    members = connected_components(links)

    # What the stars of large buckets left apart.
    large = buckets.where(away).select("band", "hash", "c", F.col("node").alias("x"))
    large = large.join(members.withColumnRenamed("node", "x"), "x", "left").withColumn("component", F.coalesce("component", "x"))
    apart = large.groupBy("c").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    open_ = written(large.join(apart, "c").select("x", "component").distinct(), "open")
    if not open_.isEmpty():
        more = _prefix_pairs(open_, texts, shingle, num, den).join(pairs, ["a", "b"], "left_anti")
        more = written(more.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS))), "pairs")
        added = written(_verified(more, texts, shingle, num, den), "links")
        if not added.isEmpty():
            members = connected_components(links.unionByName(added))

    # A component is named by the smallest id of its classes.
    named = written(members.join(classes.select("node", "rep"), "node"), "members")
    roots = named.groupBy("component").agg(F.min("rep").alias("root"))
    labelled = classes.join(named.join(roots, "component").select("node", "root"), "node", "left")
    labelled = labelled.select(*key, F.coalesce("root", "rep").alias("component_id"))
    rest = sketches.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    out = held.join(labelled, key).select("id", "n_shingles", "component_id").unionByName(rest)
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
