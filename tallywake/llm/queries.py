"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywake.llm import (
    decontaminate, kneser_ney, language, line_dedup, nra, packing, pitman_yor, prefix_trie, quality_rules, records, secrets, simhash, variants)
from tallywake.llm.common import split_of
from tallywake.llm.tokens import vocabulary
from tallywake.plans.tables import table


def op1_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    found = pitman_yor.score(table(spark, folder, "documents"), split_of("doc_id", 7).eqNullSafe(2) == F.lit(False))
    return found.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1 AND toxic = 0")
    found = kneser_ney.judge(table(spark, folder, "documents").select("doc_id", "text", "lang"), trusted)
    return found.select("doc_id", "lang", "log_perplexity", "most", "kept")


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", F.coalesce(split_of("doc_id", 3) == 1, F.lit(False)))
    known = language.prototypes(docs.where("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), known).drop("text")


def op4_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.token_file(table(spark, folder, "documents"), vocabulary())


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, folder, "benchmark"))
    n_hit = F.size("leak.hit_words").cast("bigint")
    return found.select(
        "doc_id", F.col("leak.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("leak.items").cast("bigint").alias("n_items"), F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without its repeated passages, and what that took away."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = line_dedup.dedup(docs, removed="removed")
    return found.select("doc_id", F.size("removed").cast("bigint").alias("n_removed"), "text")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "novel")

    def line(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary())


def op11_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nra.search(rows, rows.where("vec_id % 100 = 0")).select("query_id", "rank", "vec_id", "score")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pitman_yor, op2_kneser_ney, op3_language, op4_records, op5_decontaminate, op6_quality_rules, op7_simhash, op8_line_dedup,
    op9_secrets, op10_packing, op11_top_k, op12_prefix_trie, op13_spelling)}
ORACLES: dict[str, str] = {
    "op11_top_k": """
        WITH whole AS (
            SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
            FROM whole q JOIN whole r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10""",
}
