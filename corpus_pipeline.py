"""Four stages over ``documents``: quality rules, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir); ``run`` writes its result as Parquet in the
shared folder and rereads it as the next stage's docs.  All but the last return the
columns of documents.  A rejected document is gone for all later stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe.llm.common import table, written
from sondeframe.llm.neardup import near_duplicates
from sondeframe.llm.packing import pack
from sondeframe.llm.quality import keep_quality
from sondeframe.llm.tokens import public_path
from sondeframe.llm.toxicity import drop_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table; null and empty texts fail, null ids and repeated rows are judged like any other."""
    return keep_quality(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; labels are learned from the labelled documents of the whole table.

    Null and empty texts score the intercept, repeated rows score alike, null ids are judged by their text; without
    labels of both classes nothing is dropped unless all labels are toxic; very long texts are scored whole, in slices.
    """
    return drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group at 0.8 on five-word shingles; those without an id or words stay.

    A document is its id: repeated rows of a kept id all stay, and rows that share an id count as one document.
    """
    kept = near_duplicates(docs, shingle=5, num=80, den=100, bands=32, rows=5)
    kept = written(kept.where("kept and id is not null").select(F.col("id").alias("doc_id")).distinct(), "kept")
    alone = docs.where("doc_id is null")
    return docs.join(kept, "doc_id", "left_semi").unionByName(alone).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in sequences; every row is packed, an empty table gives no rows."""
    return pack(docs, public_path("byte_bpe_50k.json"), "byte", capacity=2048, end_id=0)


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity), ("near dedup", near_dedup), ("packing", packing)]
#: SQL can express neither the classifier nor the tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return written(STAGES[-1][1](spark, docs, sf_dir), "packed")
