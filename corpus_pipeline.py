"""A training corpus from raw documents: judged, without repeated passages and near copies, clean of benchmarks, packed.

Each stage takes and, but for the last, gives the columns of documents. Null and empty texts have no quality and go in the first
stage; repeated rows are near copies, of which one stays; ties go by the smaller doc_id; an empty table gives an empty corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywake.llm import decontaminate, kneser_ney, line_dedup, packing, simhash
from tallywake.llm.common import stored
from tallywake.llm.tokens import vocabulary
from tallywake.plans.tables import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity, by a model of documents labelled good and not toxic, is usual for their language."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return kneser_ney.judge(docs, trusted).where("kept").select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of lines that come earlier, n_chars being that of the text that is left."""
    return line_dedup.dedup(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences."""
    return packing.pack(docs, vocabulary(), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", passages),
    ("simhash", near_copies),
    ("decontaminate", benchmark_passages),
    ("packing", packed),
]

# Hashes, tokenizers and the packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
