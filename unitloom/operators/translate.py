"""Translation: what is left to do, prompts, and a bounded retry around an injected translator."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut
from .terms import Term, introduced, with_matches

RETRIES = 2
RESULT = "doc_id string, unit_id string, status string, text string, error string"
SPOKEN = ("para", "figure", "supplementary")


def remaining(units: DataFrame, translations: DataFrame) -> DataFrame:
    """Translatable units without an ok translation."""
    return units.where("translate").join(translations.where("status = 'ok'").select("doc_id", "unit_id"), ["doc_id", "unit_id"], "left_anti")


def context(units: DataFrame, sentences: int = 2) -> DataFrame:
    """units with context: the last sentences of the nearest translatable spoken unit before; '' if there is none."""
    plain = F.when(F.col("translate") & F.col("kind").isin(*SPOKEN), X.unmask(F.col("text"), F.col("spans")))
    w = Window.partitionBy("doc_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return units.withColumn("_plain", plain).withColumn("context", F.coalesce(X.last_sentences(F.last("_plain", ignorenulls=True).over(w), sentences), F.lit(""))).drop("_plain")


def notes(first: str, known: str, title: str) -> Column:
    part = lambda c, said: F.when(F.size(c) > 0, F.concat(F.lit(said + ": "), F.array_join(c, ", ")))
    both = F.concat_ws("; ", part(first, "first use"), part(known, "already introduced"))
    return F.when(both != "", F.concat(F.lit(title + ": "), both))


def prompts(units: DataFrame, terms: list[Term]) -> DataFrame:
    """units with prompt: glossary, abbreviation notes, first-mention notes, context and text; parts without content left out.
    State before a unit comes from windows over its document, so the cost is linear in its units."""
    rows = with_matches(context(units).withColumn("plain", X.unmask(F.col("text"), F.col("spans"))), terms)
    rows = introduced(rows, terms)
    prompt = F.concat_ws(
        "\n\n", F.when(F.coalesce("glossary", F.lit("")) != "", F.concat(F.lit("Glossary:\n"), "glossary")), notes("abbr_first", "abbr_known", "Abbreviation notes"), notes("head_first", "head_known", "First-mention notes"),
        F.when(F.col("context") != "", F.concat(F.lit("Context (do not translate): "), "context")), F.concat(F.lit("Text:\n"), "text"),
    )
    return rows.withColumn("prompt", prompt).select(*units.columns, "context", "prompt")


def chat_messages(system: str, prompt: Column) -> Column:
    """[{role, content}] for a chat model."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", prompt))


def bag_error(draft: str, source: str) -> str | None:
    """What is wrong with a draft's placeholders; the same rule as the column of that name."""
    import re
    from collections import Counter

    got, want = (Counter(re.findall(X.PLACEHOLDER, t)) for t in (draft, source))
    for said, keys in (("unknown", got.keys() - want.keys()), ("duplicated", {k for k in got if got[k] > want[k]}), ("missing", {k for k in want if got[k] < want[k]})):
        if keys:
            return f"{said} placeholders: {' '.join(sorted(keys))}"
    return None


def translate(rows: DataFrame, translator: Callable[[list[dict]], str], system: str, retries: int = RETRIES) -> DataFrame:
    """doc_id, unit_id, status, text, error of rows (doc_id, unit_id, text, prompt). translator takes chat messages and runs in the
    workers. After a draft with wrong placeholders the defect is told and it is asked again; after a failure just asked again."""

    def attempt(source: str, prompt: str) -> tuple[str, str, str | None]:
        talk = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
        draft, error = "", None
        for _ in range(retries + 1):
            try:
                draft = translator(talk).strip()
            except Exception as e:  # any failure of the outside service counts as a failed attempt
                error = str(e)
                continue
            error = bag_error(draft, source)
            if error is None:
                return "ok", draft, None
            talk += [{"role": "assistant", "content": draft}, {"role": "user", "content": f"{error}. Keep every placeholder exactly once."}]
        return "needs_repair", draft, error

    def run(batches):
        for batch in batches:
            made = [attempt(t, p) for t, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([m[k] for m in made], pa.string()) for k in range(3))], names=["doc_id", "unit_id", "status", "text", "error"])

    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), "unit_id", "text", "prompt").mapInArrow(run, RESULT)


def translate_kept(rows: DataFrame, translator: Callable[[list[dict]], str], system: str, path: str, parts: int = 64, retries: int = RETRIES) -> DataFrame:
    """translate() with results kept under path: units are dealt by hash to `parts` jobs, whose results are appended one job after the
    other. A later call asks only for units that have no ok result there, so a run that was stopped loses one job at most. Of several
    results of a unit an ok one counts, then the latest."""
    spark = rows.sparkSession
    schema = f"{RESULT}, at timestamp"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)  # so that the first run has a table to read
    kept = lambda: spark.read.schema(schema).parquet(path)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    left = cut(rows.select("doc_id", "unit_id", "text", "prompt").join(kept().where("status = 'ok'").select("doc_id", "unit_id"), ["doc_id", "unit_id"], "left_anti"))
    part = F.pmod(F.xxhash64("doc_id", "unit_id"), F.lit(parts))
    for k in range(0 if left.isEmpty() else parts):
        made = translate(left.where(part == k), translator, system, retries)
        made.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)
    best = F.max_by(F.struct("status", "text", "error"), F.struct(F.col("status") == "ok", F.col("at")))
    asked = rows.select("doc_id", "unit_id").distinct()
    return kept().join(asked, ["doc_id", "unit_id"], "left_semi").groupBy("doc_id", "unit_id").agg(best.alias("b")).select("doc_id", "unit_id", "b.*")
