"""Glossaries: JSON rows, or a Markdown table with the same content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.terms import Term
from ..schemas import PROTECTED, RULES, TERM

# Remarks in a note that are not a gloss.
NEVER = r"(?iuU)не\s+переводить|не\s+расшифровывать"
AT_FIRST = r"(?iuU)при\s+первом\s+употреблении"
HEADER = "Термин"


def split_source(cell: Column) -> Column:
    """'main (other)' to both, else the cell alone."""
    pattern = r"^(.+?)\s*\(([^)]*)\)\s*$"
    return F.when(cell.rlike(pattern), F.array(F.trim(F.regexp_extract(cell, pattern, 1)), F.trim(F.regexp_extract(cell, pattern, 2)))).otherwise(F.array(F.trim(cell)))


def split_target(cell: Column) -> Column:
    """Alternatives between commas, remarks in parentheses dropped."""
    return F.filter(F.transform(F.split(cell, ","), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s*\([^)]*\)", ""))), lambda x: x != "")


def classified(note: Column) -> Column:
    """struct(gloss, note, paren_en) of a note: a remark for editors stays a note, other text is a gloss."""
    n = F.trim(F.coalesce(note, F.lit("")))
    made = lambda gloss, kept, paren: F.struct(gloss.alias("gloss"), kept.alias("note"), F.lit(paren).alias("paren_en"))
    none = F.lit("")
    editorial = n.rlike(AT_FIRST) | F.startswith(n, F.lit("не ")) | F.contains(n, F.lit("не «"))
    return F.when(n.rlike(NEVER), made(none, n, "never")).when((n == "") | editorial, made(none, n, "first")).otherwise(made(n, none, "first"))


def stems(ru: Column) -> Column:
    return F.flatten(F.transform(ru, lambda alt: F.transform(X.matches(alt, r"(?U)[\w-]+"), lambda w: X.stem(w))))


def parse_table(markdown: DataFrame, text: str = "markdown", keep: Sequence[str] = ()) -> DataFrame:
    """Terms of Markdown tables with their place (pos) and the columns in keep; header and rule rows left out."""
    lines = markdown.select(*keep, F.posexplode(F.split(text, r"\r?\n")).alias("pos", "line")).where(F.col("line").rlike(r"^\|(.+)\|\s*$"))
    cells = F.transform(F.split(F.regexp_extract("line", r"^\|(.+)\|\s*$", 1), r"\|"), lambda x: F.trim(x))
    rows = lines.select(*keep, "pos", cells.alias("c")).where(F.size("c") >= 2).where(~F.get("c", F.lit(0)).isin(HEADER, "") & ~F.get("c", F.lit(0)).rlike("^[-:]+$"))
    first, second = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    rows = rows.select(*keep, "pos", first.alias("label"), split_source(first).alias("en"), split_target(second).alias("ru"), second.alias("ru_raw"), classified(F.get("c", F.lit(2))).alias("k"))
    return rows.select(*keep, "pos", "label", "en", "ru", "ru_raw", "k.note", stems(F.col("ru")).alias("ru_stems"), "k.gloss", "k.paren_en")


def read_terms(spark: SparkSession, path: str, markdown: str | None = None) -> DataFrame:
    """Terms from JSON; from the Markdown table if the JSON is not there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop) or markdown is None:
        rows = spark.read.schema(TERM).option("multiLine", "true").option("mode", "FAILFAST").json(path)
        return rows.withColumns({"ru_stems": F.coalesce("ru_stems", stems(F.col("ru"))), "gloss": F.coalesce("gloss", F.lit("")), "paren_en": F.coalesce("paren_en", F.lit("first"))})
    return parse_table(spark.read.text(markdown, wholetext=True).withColumnRenamed("value", "markdown")).orderBy("pos").drop("pos")


def collect_terms(terms: DataFrame, limit: int = 100_000) -> list[Term]:
    """Terms as configuration. A glossary is small; one of more than `limit` rows is refused."""
    rows = terms.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a glossary of more than {limit} terms")
    return [Term(r.label, tuple(r.en), tuple(r.ru or ()), r.ru_raw or "", r.gloss or "", r.paren_en or "first", r.note or "") for r in rows]


def read_rules(spark: SparkSession, path: str) -> tuple[tuple[str, str], ...]:
    """Banned words and what to use instead."""
    row = spark.read.schema(RULES).option("multiLine", "true").option("mode", "FAILFAST").json(path).first()
    return tuple((r.bad, r.good) for r in (row.banned_calques or ())) if row else ()


def read_protected(spark: SparkSession, path: str) -> dict[str, list[str]]:
    row = spark.read.schema(PROTECTED).option("multiLine", "true").option("mode", "FAILFAST").json(path).first()
    return {"terms": list(row.terms or ()), "patterns": list(row.patterns or ())} if row else {"terms": [], "patterns": []}


def write_terms(terms: DataFrame, path: str) -> None:
    """One JSON array, as read_terms() reads it; a glossary is small."""
    terms.agg(F.to_json(F.collect_list(F.struct(*[f.name for f in TERM.fields]))).alias("value")).write.mode("overwrite").text(path)
