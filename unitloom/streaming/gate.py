"""The verification gate over a stream of translated pairs (an extension: rules of single rows need no state, so they run as they
are; totals are kept per document by the engine's own aggregation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules as R


def stream_issues(pairs: DataFrame, lexicon: R.Lexicon = R.Lexicon()) -> DataFrame:  # noqa: B008
    """doc_id, unit_id, check, severity, message of a stream (or table) of doc_id, unit_id, source, target."""
    found = pairs.select("doc_id", "unit_id", F.explode(R.unit_rules(F.col("source"), F.col("target"), lexicon)).alias("i"))
    return found.select("doc_id", "unit_id", "i.check", "i.severity", "i.message")


def stream_gate(pairs: DataFrame, lexicon: R.Lexicon = R.Lexicon()) -> DataFrame:  # noqa: B008
    """doc_id, n_fail, n_warn so far, for update or complete output. State is two counters a document."""
    counts = pairs.select("doc_id", R.severities(R.unit_rules(F.col("source"), F.col("target"), lexicon)).alias("n"))
    return counts.groupBy("doc_id").agg(F.sum("n.n_fail").alias("n_fail"), F.sum("n.n_warn").alias("n_warn"))


def write_issues(issues: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Issues appended as Parquet, each exactly once, until the landed input is used up."""
    return issues.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
