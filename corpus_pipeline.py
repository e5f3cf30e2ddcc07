"""A corpus pipeline of five stages, each one operator of ``plumbline.llm`` over all that the stage before kept.

Null or empty texts, repeated rows, empty tables and further columns are handled as the operators state. Rows without a text
have no copies to be dropped for and are kept by every filtering stage but the classifier, which scores an
empty text like any other; rows without an id are documents of their own, which come last in a group of copies. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, jaccard_join, line_dedup, quality_classifier, sentencepiece_codec
from plumbline.llm.common import fold, save, table, trimmed

THRESHOLD = 0.7


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at least 0.7; it learns from the labels of documents still there."""
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 4) != 2)
    model = quality_classifier.fit(docs, labels)
    return quality_classifier.score(docs, model, "_score").filter(F.col("_score") >= THRESHOLD).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; documents of which nothing is left go."""
    out = line_dedup.dedup_lines(docs)
    text = out["text"]
    out = out.filter((F.col("_removed") == 0) | (trimmed(text) != ""))
    return out.withColumn("n_chars", F.when(F.col("_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents stays; of one id with several texts each is a document."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    several = rows.groupBy("doc_id").agg((F.min("_h") != F.max("_h")).alias("_several")).filter("_several or doc_id is null").select(F.col("doc_id").alias("_id"))
    named = rows.join(several.withColumn("_several", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    named = named.select("doc_id", "text", "_h", F.when(F.col("_several"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id")).alias("_key"))
    named = save(named, "near-named")
    found = jaccard_join.components(named.select(F.col("_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    members = named.select("doc_id", "_h", "_key").distinct().join(found, "_key")
    first = members.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_key")).alias("_first"))
    later = members.join(first, "_group").filter(F.col("_key") != F.col("_first._key")).select(F.col("doc_id").alias("_id"), "_h")
    kept = docs.join(later, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_h")), "left_anti")
    # rows with the same id are copies of each other only if their texts are equal
    return kept.select(*docs.columns).dropDuplicates(["doc_id", "text"])


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_ids, and whether decoding gives the text back."""
    return sentencepiece_codec.encode(docs, keep=["doc_id", "lang", "source"])


STAGES = [("quality classifier", classify), ("line dedup", dedup_lines), ("n-gram jaccard join", dedup_near),
          ("benchmark decontamination", decontaminate_benchmark), ("sentencepiece", encode)]

#: rule fitting and piece encoding have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = save(docs, f"pipeline-{at + 1}-{name.replace(' ', '-')}")
    return docs
