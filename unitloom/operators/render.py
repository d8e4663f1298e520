"""Ordered units to Markdown bodies, headers and review packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.jats import titles

# Figure labels and their translation.
LABELS = (("Figure", "Рис."), ("Fig.", "Рис."))


def plain_title(text: Column, depth: int = 4) -> Column:
    """Bold and code wrappers dropped; nesting up to `depth`."""
    for _ in range(depth):
        text = F.regexp_replace(F.regexp_replace(text, r"\*\*(.+?)\*\*", "$1"), "`([^`]+)`", "$1")
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def local_label(label: Column) -> Column:
    out = label
    for source, target in LABELS:
        out = F.when(F.startswith(label, F.lit(source)), F.concat(F.lit(target), F.substring(label, F.lit(len(source) + 1), F.length(label)))).otherwise(out)
    return out


def figure_block(graphics: Column, label: Column, body: Column) -> Column:
    """Images, then the caption with its label."""
    label = F.coalesce(label, F.lit(""))
    images = F.transform(F.coalesce(graphics, F.array().cast("array<string>")), lambda g: F.concat(F.lit("!["), F.regexp_replace(label, r"\.+$", ""), F.lit("](assets/"), g, F.lit(")")))
    caption = F.when(label != "", F.concat(F.lit("**"), label, F.lit(".** "), body)).when(body != "", body)
    return F.array_join(F.concat(images, F.array_compact(F.array(caption))), "\n\n")


def unit_blocks(units: DataFrame, translations: DataFrame | None) -> DataFrame:
    """doc_id, ordinal, kind, block (the unit's Markdown). Without translations the source; with them the target, which must have
    every translatable unit."""
    if translations is None:
        label = F.col("label")
        body = F.when(F.col("translate"), X.unmask_strict(F.col("text"), F.col("spans"))).otherwise(F.col("source_md"))
        rows = units
    else:
        label = local_label(F.col("label"))
        rows = units.join(translations.select("doc_id", "unit_id", F.col("text").alias("target")), ["doc_id", "unit_id"], "left").join(titles(units, translations), "doc_id", "left")
        there = F.when(F.col("target").isNull(), F.raise_error(F.concat(F.lit("no translation for unit "), F.col("unit_id")))).otherwise(F.col("target"))
        section = F.coalesce("titles", F.create_map().cast("map<string,string>"))
        body = F.when(F.col("translate"), X.unmask_strict(there, F.col("spans"), section)).otherwise(F.coalesce("fixed", "source_md"))
    body = F.when(F.col("kind") == "title", plain_title(body)).otherwise(body)
    block = (
        F.when(F.col("kind").isin("title", "heading"), F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), body))
        .when(F.col("kind") == "figure", figure_block(F.col("graphics"), label, body))
        .when((F.col("kind") == "supplementary") & (F.coalesce(label, F.lit("")) != ""), F.concat(F.lit("**"), label, F.lit(".** "), body))
        .otherwise(body)
    )
    return rows.select("doc_id", "ordinal", "kind", block.alias("block"))


def render(units: DataFrame, translations: DataFrame | None = None) -> DataFrame:
    """doc_id, body: blocks between blank lines; references that stand together, a line each. A document's blocks meet in one row,
    as its body does anyway."""
    return rendered(unit_blocks(units, translations))


def rendered(blocks: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("ordinal")
    island = F.sum(F.when((F.col("kind") == "ref") & (F.coalesce(F.lag("kind").over(w), F.lit("")) == "ref"), 0).otherwise(1)).over(w)
    rows = blocks.withColumn("_island", island).groupBy("doc_id", "_island").agg(F.array_sort(F.collect_list(F.struct("ordinal", "block"))).alias("b"))
    rows = rows.select("doc_id", "_island", F.array_join(F.transform("b", lambda x: x["block"]), "\n").alias("text")).where("text <> ''")
    whole = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("_island", "text"))).alias("b"))
    return whole.select("doc_id", F.concat(F.array_join(F.transform("b", lambda x: x["text"]), "\n\n"), F.lit("\n")).alias("body"))


def attribution(meta: DataFrame) -> Column:
    """The note above a translated body: authors, title, journal, year, where the original is, license."""
    kept = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    doi, link = kept("doi"), F.coalesce(kept("pdf"), kept("url"))
    place = F.coalesce(F.concat(F.lit("DOI: ["), doi, F.lit("](https://doi.org/"), doi, F.lit(")")), F.concat(F.lit("PDF: ["), link, F.lit("]("), link, F.lit(")")), F.lit("Источник: см. meta.yml"))
    return F.concat(F.lit("> **Неофициальный перевод.** Оригинал: "), F.array_join("authors", ", "), F.lit(". «"), F.col("title"), F.lit("». "), F.col("journal"), F.lit(", "), F.col("year").cast("string"), F.lit(". "), place, F.lit(". Лицензия: "), F.col("license"), F.lit(".\n\n"))


def published_body(papers: DataFrame) -> Column:
    """Title line, attribution, rest of the body."""
    first, rest = F.substring_index("body", "\n", 1), F.regexp_replace(F.expr("substring(body, length(substring_index(body, '\n', 1)) + 2)"), r"(?U)^\s+", "")
    return F.concat(first, F.lit("\n\n"), attribution(papers), rest)


#: Headings and hints of the checklist at a review pack's end (fixed values).
CHECKLIST = (
    ("Fluency", "Natural academic Russian; no calques or broken syntax."),
    ("Hedging", "Modality matches source (may ≠ does; suggests ≠ shows)."),
    ("Numbers", "All figures, units, DOIs, and citations match the source."),
)


def review_pack(units: DataFrame, translations: DataFrame, issues: DataFrame, hits: DataFrame) -> DataFrame:
    """doc_id, review: each unit beside its translation, with glossary hits (doc_id, unit_id, pos, line) and issues; then the
    document's own issues and a checklist."""
    line = F.concat(F.lit("- "), "severity", F.lit(" `"), "check", F.lit("`: "), "message")
    listed = issues.withColumn("line", line)
    per_unit = listed.groupBy("doc_id", "unit_id").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("issue_lines"))
    per_hit = hits.groupBy("doc_id", "unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: F.concat(F.lit("- "), x["line"])), "\n").alias("hit_lines"))
    rows = units.join(translations.select("doc_id", "unit_id", F.col("text").alias("target")), ["doc_id", "unit_id"], "left").join(per_unit, ["doc_id", "unit_id"], "left").join(per_hit, ["doc_id", "unit_id"], "left")
    source = F.coalesce(F.nullif(F.col("source_md"), F.lit("")), X.unmask(F.col("text"), F.col("spans")))
    target = F.when(F.col("translate"), F.coalesce(F.nullif(F.col("target"), F.lit("")), F.lit("_(missing translation)_"))).otherwise(F.coalesce("fixed", source))
    none = F.lit("- _(none)_")
    part = F.concat_ws(
        "\n\n", F.concat(F.lit("### "), "unit_id", F.lit(" ("), "kind", F.lit(")")), F.lit("**EN**"), F.coalesce(F.nullif(source, F.lit("")), F.lit("_(empty)_")), F.lit("**RU**"), target,
        F.lit("**Glossary hits**"), F.coalesce("hit_lines", none), F.lit("**Verify warnings**"), F.coalesce("issue_lines", none),
    )
    body = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", part.alias("part")))).alias("p")).select("doc_id", F.array_join(F.transform("p", lambda x: x["part"]), "\n\n").alias("parts"))
    own = per_unit.where("unit_id = '-'").select("doc_id", F.concat(F.lit("## Paper-level verify\n\n"), "issue_lines").alias("own"))
    check = "## MQM checklist\n\n" + "\n\n".join(f"### {t}\n\n_{h}_\n\n" + "\n".join(f"- [ ] {k}: _(none / list)_" for k in ("Critical issues", "Major issues", "Minor notes")) for t, h in CHECKLIST)
    lead = F.concat(F.lit("# Review pack: "), "doc_id", F.lit("\n\nAdvisory only — scripted `verify` remains the gate. Fill the MQM checklist below."))
    tail = F.lit("## Issues for repair\n\nList unit IDs and fixes (feeds `fix_unit` / re-verify):\n\n1. \n")
    return body.join(own, "doc_id", "left").select("doc_id", F.concat_ws("\n\n", lead, F.lit("## Units"), "parts", "own", F.lit(check), tail).alias("review"))
