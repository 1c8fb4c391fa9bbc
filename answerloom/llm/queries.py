"""Registered queries of this subpackage: ``opN_name`` (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm.archive import header_field, read_archive, sha1_base32, write_archive
from answerloom.llm.bpe import decode_ids, encode_texts, token_count
from answerloom.llm.collocations import collocations
from answerloom.llm.digests import exact_dedup
from answerloom.llm.extraction import extract_pages
from answerloom.llm.importance import importance_resample
from answerloom.llm.kdtree import exact_topk, integer_vectors
from answerloom.llm.lines import dedup_lines
from answerloom.llm.minhash import near_duplicates
from answerloom.llm.mixing import mix_plan, word_count
from answerloom.llm.repair import damaged, repair_conversations, summarise
from answerloom.llm.rules import cascade
from answerloom.llm.sharding import histogram_shards, text_keys, text_size
from answerloom.sources.staging import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: 24 shards of near equal bytes, sorted by text digest and id."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = histogram_shards(docs, text_keys("text", "doc_id"), text_size("text"), 24)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return out.select(
        "doc_id",
        text_size("text").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document; a class is a connected group of near-duplicates."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).drop("node")


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without lines that occur elsewhere, exactly or nearly."""
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a content-addressed WARC archive and read back."""
    path = new_path(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    refers = F.regexp_extract(header_field("header", "WARC-Refers-To"), r"record:(-?\d+)>", 1)
    return read_archive(spark, path).select(
        F.col("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"),
        header_field("header", "WARC-Type").alias("record_type"),
        refers.try_cast("bigint").alias("refers_to"),
    )


def op5_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 3, 1, 2 of their sources, 150 % of all words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_plan(docs, word_count("text")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )


def op6_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    points = integer_vectors(vectors, "vec_id", "embedding")
    return exact_topk(points, F.col("vec_id") % 50 == 0, 5)


def tokenizer(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    """Content of a public rank file and its pattern, read where the query is planned."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op7_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of ids and bytes."""
    blob, pattern = tokenizer()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode_ids(encode_texts(docs, blob, pattern).drop("text"), blob, pattern)
    return coded.select(
        "doc_id",
        token_count("token_ids").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the rule cascade for every document."""
    return cascade(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op9_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract_pages(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log weight, perturbed score and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_resample(docs, _table(spark, sf_dir, "labels")).drop("text")


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, edits and digest of every damaged and repaired conversation."""
    turns = damaged(_table(spark, sf_dir, "conversations"))
    return summarise(repair_conversations(turns, absent="absent")).withColumnRenamed("conv", "conv_id")


def op12_digest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equals."""
    return exact_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {
    "op1_histogram_sort": op1_histogram_sort,
    "op2_weighted_minhash": op2_weighted_minhash,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_content_archive": op4_content_archive,
    "op5_cube_mix": op5_cube_mix,
    "op6_kdtree_topk": op6_kdtree_topk,
    "op7_recursive_bpe": op7_recursive_bpe,
    "op8_rule_cascade": op8_rule_cascade,
    "op9_crf_extraction": op9_crf_extraction,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_digest_merge": op12_digest_merge,
    "op13_collocations": op13_collocations,
}
