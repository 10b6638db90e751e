"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe.llm import oracle, tokencounts
from sondeframe.llm.ann import nearest
from sondeframe.llm.common import table, work_path, written
from sondeframe.llm.exactdup import exact_duplicates
from sondeframe.llm.idfile import round_trip
from sondeframe.llm.neardup import near_duplicates
from sondeframe.llm.packing import pack
from sondeframe.llm.periodruns import periodic_runs
from sondeframe.llm.quality import quality
from sondeframe.llm.spviterbi import encoded
from sondeframe.llm.tokens import public_path
from sondeframe.llm.toxicity import toxicity
from sondeframe.llm.urlfilter import judge_urls
from sondeframe.llm.vafile import hard_negatives
from sondeframe.llm.warczip import archive_round_trip


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85, den=100, bands=25, rows=5)
    return out.withColumnRenamed("id", "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = {f"{n}@1": (public_path(f"{n}.json"), kind) for n, kind in (("byte_bpe_50k", "byte"), ("word_bpe_49k", "word"))}
    counted = tokencounts.count_tokens(table(spark, sf_dir, "documents").select("source", "lang", "text"), versions)
    rollup, compacted = work_path(spark, "rollup"), work_path(spark, "rollup")
    # Texts are tokenized once: the feed's sums and one document of each group.
    sums = F.count("*").alias("d_docs"), F.sum("n_tokens").alias("d_tokens"), F.min("n_tokens").alias("n_tokens")
    feed = written(counted.groupBy(*tokencounts.KEYS).agg(*sums), "feed")
    inserts, one = feed.drop("n_tokens"), feed.select(*tokencounts.KEYS, "n_tokens")
    tokencounts.commit(inserts, rollup, "documents")
    # That document leaves, enters again with another count, and is revised back: the totals stay.
    more = one.withColumn("n_tokens", F.col("n_tokens") + 1)
    tokencounts.commit(tokencounts.deletes(one), rollup, "delete")
    tokencounts.commit(tokencounts.inserts(more), rollup, "insert")
    tokencounts.compact(spark, rollup, compacted)
    tokencounts.commit(inserts, compacted, "documents")  # a retry after compaction
    tokencounts.commit(tokencounts.revisions(more, one), compacted, "revise")
    tokencounts.commit(tokencounts.revisions(more, one), compacted, "revise")
    return tokencounts.totals(spark, compacted)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), "byte", capacity=2048, end_id=0)


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), "word", end_id=1, vocab=49_408)


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"), with_ids=False)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: by a checksum of its id, a tenth of the texts repeat some of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    docs = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, split).alias("words")).withColumn("n", F.size("words"))
    docs = docs.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    repeat = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    words = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeat, F.lit(1), F.col("n") - F.col("a")))
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs, least=24, times=3)

    def larger(x, y):
        """Greater length / period first (as a fraction), then smaller start and period."""
        first = x["length"] * y["period"] - y["length"] * x["period"]
        return F.when(first != 0, -F.signum(first)).when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")

    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    top = F.get(F.array_sort("runs", larger), F.lit(0))
    found = found.select("id", "collapsed", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), lines.alias("lines"))
    return found.select(
        F.col("id").alias("doc_id"), "n_runs", "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"), F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where("label is not null and embedding is not null")
    rows = rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)


QUERIES = {
    "op2_sentencepiece": op2_sentencepiece,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op7_toxicity": op7_toxicity,
    "op10_warc_archives": op10_warc_archives,
    "op1_token_counts": op1_token_counts,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_token_id_output": op6_token_id_output,
    "op4_url_filters": op4_url_filters,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_exact_dedup": op13_exact_dedup,
}
ORACLE: dict[str, str] = {
    "op8_minhash_near_dedup": oracle.OP8,
    "op9_quality_rules": oracle.OP9,
    "op10_warc_archives": oracle.OP10,
    "op11_hard_negatives": oracle.OP11,
    "op13_exact_dedup": oracle.OP13,
}
