"""The corpus pipeline: five stages from raw documents to packed sequences of tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of ``documents``, with ``n_chars`` following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import langid, lines, neardups, packing, secrets
from tallyspark.llm.shipping import ship
from tallyspark.session import stage_table

#: A document whose pooled probability of the best language is below this is rejected.
LEAST_SCORE = 0.35


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those in none of the languages of the corpus."""
    ship(spark)
    judged = langid.identify(docs, langid.fit(docs))
    return judged.filter((F.col("lang_pred") != langid.UNKNOWN)
                         & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines, and documents that had no others."""
    ship(spark)
    left = lines.dedup_lines(docs)
    return _counted(left.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")),
                    docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, of the least id; every row is judged
    by its own text, whether its id is null or repeated."""
    ship(spark)
    return neardups.first_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark."""
    return _counted(secrets.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of 2048 tokens; a row for each piece."""
    import public_tokenizers
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Language identification by a trained network has no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again by the next."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage_table(stage(spark, out, sf_dir), name)
    return STAGES[-1][1](spark, out, sf_dir)
