"""Corpus pipeline over ``documents``: quality, lines, near-duplicates, mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm.bpe import round_trip, token_count
from answerloom.llm.importance import importance_resample
from answerloom.llm.lines import dedup_lines
from answerloom.llm.minhash import drop_near_duplicates
from answerloom.llm.mixing import mix, word_count
from answerloom.llm.queries import tokenizer
from answerloom.sources.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; texts without a token go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = importance_resample(docs, labels)
    *own, _, _, kept = scored.columns
    return scored.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in own])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur elsewhere.

    Documents of which no line is left go; ``n_chars`` counts the new text.
    """
    out = dedup_lines(docs)
    *own, _, dropped = out.columns
    left = (F.col(dropped) == 0) | F.col("text").rlike(r"[\p{L}\p{N}]")
    out = out.where(left).select(*[F.col(f"`{c}`") for c in own])
    if "n_chars" in own:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", length)
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources; a document occurs as often as the mix takes it."""
    return mix(docs, word_count("text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix, and whether they decode to the text."""
    blob, pattern = tokenizer()
    slim = docs.select("doc_id", "source", "text")
    coded = round_trip(slim, blob, pattern)
    return coded.select(
        "doc_id",
        "source",
        token_count("token_ids").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL has neither the hash functions nor the random draws of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
