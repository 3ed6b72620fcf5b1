"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All stages but the last keep the
columns of ``documents``, including any that the caller has added.

quality   drops documents that the quality classifier scores below 0.3
language  drops documents without a recognised language (no letters, or no clear lead)
near_dup  keeps one row of each group of near-duplicate texts (five-word shingles,
          Jaccard similarity 0.8 or more), that of the smallest doc_id; a row without
          doc_id is kept if no row of its group has one; texts without words link with
          nothing
pii       replaces personal data by its kind in angle brackets and updates n_chars
packing   packs the texts into sequences of at most 4096 tokens

SQL cannot express the classifier, so there is no ORACLE_SQL; the tests hold the stages
against brute force. Null texts count as empty ones: quality and language drop them.
An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondliq.llm import jaccard, langid, packing, pii, quality
from bondliq.llm.common import let_workers_import, table, written
from bondliq.llm.queries import WORD_BPE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return langid.kept(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    # the caller's columns travel in one, so that no name clashes with those made here
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, doc_id = F.col("row").getField("text"), F.col("row").getField("doc_id")
    has_words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # texts are linked, not ids; a text is known by two hashes and its length
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"), F.length(text).alias("n"))
    place = F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"))
    rows = packed.where(has_words).select("row", key.alias("key"), place.alias("place"))
    texts = rows.groupBy("key").agg(F.first("row.text").alias("text"), F.min("place").alias("place"))
    texts = written(texts.withColumn("doc_id", F.monotonically_increasing_id()), "texts")
    found = jaccard.join(texts.select("doc_id", "text"), threshold=(80, 100), width=5)
    best = texts.drop("text").join(found, "doc_id").groupBy("component_id").agg(F.min(F.struct("place", "key")).alias("kept"))
    # equal rows under one id, or without one, are copies of one another
    one = rows.join(best.select("kept.*"), ["place", "key"], "left_semi").dropDuplicates(["place", "key"]).select("row.*")
    blank = docs.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return one.unionByName(blank.where("doc_id is not null").dropDuplicates(["doc_id", "text"])).unionByName(blank.where("doc_id is null"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.masked(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return packing.pack(docs, WORD_BPE, end_id=1, tokens=4096)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dup", near_dup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
