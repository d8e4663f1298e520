"""A corpus pipeline of five training-data operators over documents.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents. Stages judge rows, not doc_ids: rows that
share a doc_id, or have none, stay or go each by its own text. Every stage gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitloom.llm.common import Scratch, join_counted, quoted, small, small_broadcast
from unitloom.llm.minhash import MinHashSpec, near_duplicates
from unitloom.llm.mixing import MixSpec, mix_sources
from unitloom.llm.packing import PackSpec, pack_documents
from unitloom.llm.quality import robust_outliers, row_keys
from unitloom.llm.queries import byte_ranks
from unitloom.llm.relative_lz import cut_spans


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fail the base rule or are robust outliers of their language and source go.

    Null, empty and wordless texts fail the base rule. A verdict hangs on a row's text, language (null is one of its own) and source
    alone, so equal rows go or stay together, and of rows with one doc_id each has its own verdict."""
    scratch = Scratch(spark, "quality-stage")
    gone = robust_outliers(docs).where("not kept").groupBy(F.col("row1").alias("_row1"), F.col("row2").alias("_row2")).agg(F.count(F.lit(1)).alias("_n"))
    gone = scratch.write(gone, "gone")
    rows, keys = row_keys(docs), ["_row1", "_row2"]
    left = rows.join(F.broadcast(gone), keys, "left_anti") if small(gone) else join_counted(rows, gone.withColumn("_gone", F.lit(True)), keys, "left", n="_n").where("_gone is null")
    return left.select(*quoted(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity 0.8 or more) stays: that of the smallest id.

    Null, empty and wordless texts are like nothing and stay. Rows that share a doc_id, or have none, are told apart by a hash of their
    text, which then stands for their id: of equal ones one row stays, different ones are documents of their own."""
    scratch = Scratch(spark, "minhash-stage")
    shared = scratch.write(docs.groupBy(F.col("doc_id").alias("_shared")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or _shared is null").drop("_n"), "shared")
    rows = docs.join(small_broadcast(shared.withColumn("_several", F.lit(True))), F.col("doc_id").eqNullSafe(F.col("_shared")), "left").drop("_shared")
    rows = rows.withColumn("_node", F.when(F.col("_several"), F.xxhash64(F.lit(8), F.col("doc_id").isNull(), "doc_id", "text")).otherwise(F.col("doc_id").cast("long")))
    found = near_duplicates(rows.select(F.col("_node").alias("doc_id"), "text"), MinHashSpec(shingle=5, percent=80))
    gone = scratch.write(found.where("not kept").select(F.col("doc_id").alias("_node")), "gone")
    left = rows.join(small_broadcast(gone), "_node", "left_anti")
    once = left.where("_several is null").unionByName(left.where("_several").dropDuplicates(["_node"]))
    return once.select(*quoted(*docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of 50 words or more that a document of smaller doc_id has are cut from the texts; n_chars follows.

    Every row stays. Null and empty texts, and rows without a doc_id, lose nothing; rows of one doc_id lose nothing to each other."""
    cut = cut_spans(docs, least=50)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*quoted(*docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents whose tokens come to the target weights of sources, languages and topics.

    Null sources and languages are categories of their own. Documents without tokens weigh nothing and stay. Rows of one doc_id in one
    cell are drawn together."""
    return mix_sources(docs, MixSpec(byte_ranks(spark), keep=0.7)).where("selected").select(*quoted(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in training sequences of several lengths.

    Null and empty texts hold an end mark. Repeated rows are packed each."""
    return pack_documents(docs, PackSpec(byte_ranks(spark)))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("mixing", mixing), ("packing", packing)]

#: Several stages iterate or parse beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if k > 0:
            scratch.drop(STAGES[k - 1][0])
    return docs
