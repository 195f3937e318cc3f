"""The queries of this subpackage: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .decontaminate import contamination
from .embedding_dedup import near_vectors
from .fill_middle import fill_in_middle, restored
from .language import declared_in, fit, host_of, identify, visible
from .mixing import sampled
from .near_dedup import near_duplicates
from .packing import pack
from .sql import SQL
from .substring_dedup import remove_repeats
from .suffix_dedup import remove_repeated_bytes
from .token_files import token_counts
from .urls import filter_urls
from .warc import archive_round_trip


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, fit(docs.select("doc_id", "text", "lang")), host_col="source")


def op3b_language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with markup, address suffix and host: pages, with the text model of the documents."""
    pages = _table(spark, sf_dir, "pages").select("page_id", visible(F.col("html")).alias("text"), host_of(F.col("url")).alias("host"), declared_in(F.col("html")).alias("declared"))
    out = identify(pages, fit(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")), id_col="page_id", host_col="host", declared_col="declared")
    return out.withColumnRenamed("doc_id", "page_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=49407)


#: Fixed values of the contract.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13, share=20)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), capacity=2048)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` has no times: a page was captured as many seconds after the year began as its id says."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html", F.expr("timestampadd(SECOND, page_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("captured"))
    return archive_round_trip(pages, time_col="captured").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "history")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(_table(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, percent=50, spm_percent=80)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    again = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"), digest(again).alias("restored_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), least=30, longest=4, share=80, most=2000)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampled(_table(spark, sf_dir, "documents"), ["doc_id"], weights=(3, 1, 2), percent=150, most=2)
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
