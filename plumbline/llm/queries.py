"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (ann_search, chat, decontaminate, fill_in_middle, jaccard_join, language_id, language_model, line_dedup, periodic_runs,
                           quality_classifier, quality_rules, sentencepiece_codec, sharding)
from plumbline.llm.common import fold, table, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(fold(F.col("doc_id"), 5) != 0))
    return language_id.predict(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


#: control strings in a text must come back unharmed
ADVERSARIAL = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def _chat_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for conv, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss_spans"]):
            turns = chat.parse(text)
            said = "".join(f"{role}\n{body}\n" for role, body, _, _ in turns)
            loss = chat.ESCAPED.sub(r"\1", "".join(text[s["start"]:s["end"]] for s in spans))
            rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(ADVERSARIAL, "conv_id bigint, turn bigint, role string, text string")
    out = chat.format_conversations(turns.unionByName(extra))
    return out.select("conv_id", "formatted", "loss_spans").mapInPandas(
        _chat_digests, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return checked.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                          F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 4) != 2)
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("_removed").alias("removed_lines"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.select("doc_id", "item_id", "diagonal", "n_item", "covered", "slots").distinct()


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"))


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model.score(docs, fold(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The texts that the contract asks for: in every tenth document the words from some place on repeat with some period."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = docs.withColumn("_w", F.when(hashed % 10 == 0, words_of(F.col("text"))))
    n, g = F.size("_w"), F.floor(hashed / 10)
    planted = (words.withColumn("_a", (g % n).cast("int")).withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int")))
    again = F.transform("_w", lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get("_w", F.col("_a") + (i - F.col("_a")) % F.col("_p"))))
    return planted.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")), 12)
    # the longest; of equal lengths the one that starts first, then the shorter period
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), (-F.col("_best.length")).alias("length"),
        F.col("_best.period").alias("period"), F.expr("-_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
