"""Writing results: tables as Parquet or JSON, bodies as text, state as an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.render import published_body
from ..schemas import STATE


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Units, translations or issues; whole files appear at commit only."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_bodies(bodies: DataFrame, path: str) -> None:
    """doc_id and body, a text file's worth per document, in folders by document."""
    bodies.select("doc_id", F.col("body").alias("value")).write.mode("overwrite").partitionBy("doc_id").option("lineSep", "\n").text(path)


def write_reviews(reviews: DataFrame, path: str) -> None:
    """Review packs (doc_id, review), as write_bodies() writes bodies."""
    write_bodies(reviews.select("doc_id", F.col("review").alias("body")), path)


def write_index(papers: DataFrame, path: str) -> None:
    """Published pages: title line, attribution and the rest of the body of papers (slug and the columns of published_body())."""
    write_bodies(papers.select(F.col("slug").alias("doc_id"), published_body(papers).alias("body")), path)


def write_repair_report(report: DataFrame, path: str) -> None:
    """Outcomes of repair() (round, doc_id, unit_id, fixed), a JSON row each, in folders by round."""
    report.write.mode("overwrite").partitionBy("round").json(path)


def write_catalog(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)


def append_state(spark: SparkSession, path: str, slug: str, step: str, exit_code: int) -> None:
    row = spark.range(1).select(F.lit(slug).alias("slug"), F.lit(step).alias("last_step"), F.lit(exit_code).alias("exit_code"), F.current_timestamp().alias("ts"))
    row.write.mode("append").parquet(path)


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each slug."""
    rows = spark.read.schema(STATE).parquet(path)
    return rows.groupBy("slug").agg(F.max_by(F.struct("last_step", "exit_code", "ts"), "ts").alias("s")).select("slug", "s.*")


def state_json(state: DataFrame) -> DataFrame:
    return state.select("slug", F.to_json(F.struct("last_step", "exit_code")).alias("json"))


def read_state_json(rows: DataFrame) -> DataFrame:
    """Back from JSON; a corrupt row fails the job rather than start afresh."""
    return rows.select("slug", F.from_json("json", "last_step string, exit_code int", {"mode": "FAILFAST"}).alias("s")).select("slug", "s.*")
