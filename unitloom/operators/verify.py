"""Verification of translated documents: issues of units, documents and bodies, and the gate over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as X
from ..session import cut
from .terms import Term, abbreviation_issues, consistency_issues, first_mention_issues, lost_terms, missing_terms, term_mentions, unit_findings

COLUMNS = ("doc_id", "unit_id", "check", "severity", "message")


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    out = first.select(*COLUMNS)
    for df in rest:
        out = out.unionByName(df.select(*COLUMNS))
    return out


def issues_of(rows: DataFrame, issues) -> DataFrame:
    """rows (doc_id, unit_id) and an array of issues, one row each."""
    return rows.select("doc_id", "unit_id", F.explode(issues).alias("i")).select("doc_id", "unit_id", "i.check", "i.severity", "i.message")


def status_issues(translations: DataFrame) -> DataFrame:
    bad = translations.where(~F.coalesce(F.col("status") == "ok", F.lit(False)))
    return bad.select("doc_id", "unit_id", F.lit("status").alias("check"), F.lit("FAIL").alias("severity"), F.lit("needs repair").alias("message"))


def translated_pairs(units: DataFrame, translations: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Translatable units with their accepted translation (target, null if there is none), plain and plain_target (placeholders
    restored), exceptions."""
    ok = translations.where("status = 'ok'").select("doc_id", "unit_id", F.col("text").alias("target"))
    rows = units.where("translate").join(ok, ["doc_id", "unit_id"], "left")
    if exceptions is None:
        rows = rows.withColumn("exceptions", F.array().cast("array<string>"))
    else:
        rows = rows.join(exceptions.select("doc_id", "unit_id", F.col("terms").alias("exceptions")), ["doc_id", "unit_id"], "left")
    return restored(rows)


def restored(rows: DataFrame) -> DataFrame:
    """rows (text, target, spans, exceptions) with the columns that translated_pairs() adds."""
    return rows.withColumns({"plain": X.unmask(F.col("text"), F.col("spans")), "plain_target": F.when(F.col("target").isNotNull(), X.unmask(F.col("target"), F.col("spans"))), "exceptions": F.coalesce("exceptions", F.array().cast("array<string>"))})


def unit_issues(pairs: DataFrame, terms: list[Term], lexicon: R.Lexicon) -> DataFrame:
    """Issues of each translated unit by itself. pairs: translated_pairs() with matches."""
    there = pairs.where("target is not null")
    return union_all(issues_of(there, R.unit_rules(F.col("text"), F.col("target"), lexicon)), missing_terms(there, terms))


def structure_issues(pairs: DataFrame) -> DataFrame:
    """Kinds of which not every unit is translated."""
    counts = pairs.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.count("target").alias("m")).where("n <> m")
    return counts.select("doc_id", F.lit("-").alias("unit_id"), F.lit("structure").alias("check"), F.lit("FAIL").alias("severity"), F.format_string("%s: %d in source, %d translated", "kind", "n", "m").alias("message"))


def document_issues(pairs: DataFrame, terms: list[Term]) -> DataFrame:
    """Issues that need a document's units together and in order."""
    mentions = term_mentions(pairs.withColumn("plain_target", F.coalesce("plain_target", F.lit(""))), terms)
    return union_all(structure_issues(pairs), mention_issues(mentions))


def mention_issues(mentions: DataFrame) -> DataFrame:
    return union_all(first_mention_issues(mentions), abbreviation_issues(mentions), consistency_issues(mentions))


def images(bodies: DataFrame, *more: Column) -> DataFrame:
    """doc_id, in_source, in_target: the names of the images of both bodies."""
    return bodies.select("doc_id", *[X.matches(F.col(c), X.IMAGE, 1).alias(n) for c, n in (("body_source", "in_source"), ("body_target", "in_target"))], *more)


def figure_issues(units: DataFrame, bodies: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Graphics of figures that a body or, if files (doc_id, name) is given for the document, the folder lacks."""
    return image_issues(units, images(bodies), files)


def image_issues(units: DataFrame, held: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """figure_issues() by the images() of the bodies."""
    wanted = units.where("kind = 'figure'").select("doc_id", "unit_id", F.explode("graphics").alias("name"))
    lacks = lambda names, where: F.when(~F.array_contains(names, F.col("name")), F.concat(F.lit("missing image assets/"), "name", F.lit(f" in {where}")))
    both = F.filter(F.array(lacks("in_source", "EN"), lacks("in_target", "RU")), lambda m: m.isNotNull())
    out = wanted.join(held.select("doc_id", "in_source", "in_target"), "doc_id").select("doc_id", "unit_id", F.explode(both).alias("message"))
    if files is not None:
        known = wanted.join(files.select("doc_id").distinct(), "doc_id", "left_semi").join(files, ["doc_id", "name"], "left_anti")
        out = out.unionByName(known.select("doc_id", "unit_id", F.concat(F.lit("missing file assets/"), "name").alias("message")))
    return out.select("doc_id", "unit_id", F.lit("figures").alias("check"), F.lit("FAIL").alias("severity"), "message")


def body_issues(bodies: DataFrame) -> DataFrame:
    """Links, citations, references and placeholders of whole bodies (doc_id, body_source, body_target)."""
    return issues_of(bodies.withColumn("unit_id", F.lit("-")), R.body_rules(F.col("body_source"), F.col("body_target")))


def verify(units: DataFrame, translations: DataFrame, bodies: DataFrame, terms: list[Term], lexicon: R.Lexicon = R.Lexicon(), exceptions: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """All issues: doc_id, unit_id ('-' for the document), check, severity, message."""
    return verify_pairs(translated_pairs(units, translations, exceptions), status_issues(translations), units, bodies, terms, lexicon, files)


def verify_pairs(pairs: DataFrame, status: DataFrame, units: DataFrame, bodies: DataFrame, terms: list[Term], lexicon: R.Lexicon = R.Lexicon(), files: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """verify() of pairs as translated_pairs() gives them. The texts are read once each, and only what the rules found in them is
    written: no text is kept, sorted or shuffled for the rules of whole documents."""
    found = cut(unit_findings(pairs, terms, R.unit_rules(F.col("text"), F.col("target"), lexicon)))
    by_unit, mentions = found.where("label is null").withColumn("target", F.when(F.col("done"), F.lit(True))), found.where("label is not null")
    by_body = cut(images(bodies, F.lit("-").alias("unit_id"), R.body_rules(F.col("body_source"), F.col("body_target")).alias("issues")))
    return union_all(
        status, issues_of(by_unit, F.col("issues")), lost_terms(mentions, F.col("lost")), structure_issues(by_unit), mention_issues(mentions),
        issues_of(by_body, F.col("issues")), image_issues(units, by_body, files),
    )


def gate(documents: DataFrame, issues: DataFrame) -> DataFrame:
    """doc_id, n_fail, n_warn, exit_code (1 any FAIL, 2 only WARN, 0 clean) of every document."""
    counts = issues.groupBy("doc_id").agg(F.count_if(F.col("severity") == "FAIL").alias("n_fail"), F.count_if(F.col("severity") == "WARN").alias("n_warn"))
    rows = documents.select("doc_id").join(counts, "doc_id", "left").select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_fail", "n_warn")])
    return rows.withColumn("exit_code", F.when(F.col("n_fail") > 0, 1).when(F.col("n_warn") > 0, 2).otherwise(0))


def publishable(gated: DataFrame, force: bool = False) -> DataFrame:
    """Documents that may be published: all but those of exit code 1, or all with force."""
    return gated if force else gated.where("exit_code <> 1")


def finished(translations: DataFrame) -> DataFrame:
    """doc_id, done: whether every translation of a document is ok (documents without any are absent, so not done)."""
    return translations.groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("status") == "ok", F.lit(False))).alias("done"))


def mutation_recall(mutants: DataFrame) -> DataFrame:
    """mutation, caught: whether any copy so mutated raised a FAIL. mutants: mutation, source, target."""
    flagged = mutants.select("mutation", F.exists(F.concat(R.unit_rules(F.col("source"), F.col("target")), R.body_rules(F.col("source"), F.col("target"))), lambda i: i["severity"] == "FAIL").alias("fail"))
    return flagged.groupBy("mutation").agg(F.bool_or("fail").alias("caught"))
