"""Queries of the training-data operators: (spark, folder of tables) -> DataFrame, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, quality, url_filter, warc
from .language import LanguageSpec, identify
from .media import media_table
from .minhash import MinHashSpec, near_duplicates
from .mixing import MixSpec, mix_sources
from .packing import PackSpec, pack_documents
from .relative_lz import cut_spans

#: Folder of the public vocabulary files, where spark.unitloom.vocabularies does not name another.
VOCABULARIES = "/opt/tokenizers"


def vocabulary(spark: SparkSession, name: str) -> str:
    """Path of a public vocabulary file. The setting spark.unitloom.vocabularies names their folder."""
    return f"{spark.conf.get('spark.unitloom.vocabularies', VOCABULARIES)}/{name}"


def byte_ranks(spark: SparkSession) -> str:
    return vocabulary(spark, "byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics, and rejection by robust Mahalanobis distance per language and source."""
    return quality.robust_outliers(table(spark, folder, "documents")).drop("distance2", "row1", "row2")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of four rules on every page's url."""
    return url_filter.judge_urls(table(spark, folder, "pages"), url_filter.rule_table(spark, url_filter.RULES))


def op3_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in bins of several lengths."""
    return pack_documents(table(spark, folder, "documents"), PackSpec(byte_ranks(spark)))


def op4_media(spark: SparkSession, folder: str) -> DataFrame:
    """Every text stored as a PNG in tar shards and read back."""
    return media_table(table(spark, folder, "documents")).drop("digest", "shard", "offset", "length")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's calibrated probability, and whether it is drawn."""
    found = mix_sources(table(spark, folder, "documents"), MixSpec(byte_ranks(spark)))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected", "marginal_miss")


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page archived and read back."""
    return warc.archived(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, learned from the four fifths that are not held out."""
    docs = table(spark, folder, "documents")
    held_out = lambda: F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return identify(docs, ~held_out(), LanguageSpec(vocabulary(spark, "piece_bpe_32k.model"))).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes over 2-word shingles at Jaccard 0.8."""
    return near_duplicates(table(spark, folder, "documents"), MinHashSpec(shingle=2, percent=80))


def op9_relative_lz(spark: SparkSession, folder: str) -> DataFrame:
    """50-word windows that start in an earlier document, removed from each document."""
    return cut_spans(table(spark, folder, "documents").select("doc_id", "text"), least=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """Every message, mailed with two levels of quotation, linked to what it quotes and freed of quotes."""
    return chat.link_replies(chat.as_mail(table(spark, folder, "conversations")))


def queries() -> dict:
    found = (op1_robust_outliers, op2_url_filter, op3_best_fit, op4_media, op5_mixing, op6_warc, op7_language, op8_minhash, op9_relative_lz, op10_quotation_links)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_robust_outliers": quality.oracle(), "op2_url_filter": url_filter.ORACLE, "op6_warc": warc.ORACLE, "op10_quotation_links": chat.ORACLE}
