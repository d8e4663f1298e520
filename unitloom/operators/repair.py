"""Repair of failing units: mechanical fixes as columns, then a pluggable translator, then the acceptance gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as X
from ..session import cut
from .terms import Term, missing_terms, with_matches
from .verify import translated_pairs

ROUNDS = 2


def restore_numbers(source: Column, target: Column) -> Column:
    """Decimal commas of the target to points; then, if both have as many numbers, the source's in the target's places. Digits of
    placeholders are not numbers."""
    HIDDEN = "\ue000"  # stands for a placeholder while numbers are found

    def swapped(pointed: Column, held: Column, want: Column, pieces: Column) -> Column:
        filled = X.let({"parts": F.split(X.woven(pieces, want), HIDDEN, -1)}, lambda parts: X.woven(parts, held))
        return F.when(F.size(pieces) - 1 == F.size(want), filled).otherwise(pointed)

    def bound(pointed: Column) -> Column:
        hidden = F.regexp_replace(pointed, X.PLACEHOLDER, HIDDEN)
        return X.let({"pointed": pointed, "held": X.placeholders(pointed), "want": X.matches(X.strip_placeholders(source), X.NUMBER), "pieces": F.split(hidden, X.NUMBER, -1)}, swapped)

    return X.let({"pointed": X.decimal_points(target)}, bound)


def restore_links(source: Column, target: Column) -> Column:
    """If both have as many links, the source's in the target's places."""
    filled = lambda want, got, pieces: F.when((F.size(want) == F.size(got)) & (want != got), X.woven(pieces, want))
    return F.coalesce(X.let({"want": X.matches(source, X.LINK), "got": X.matches(target, X.LINK), "pieces": F.split(target, X.LINK, -1)}, filled), target)


def mechanical(source: Column, target: Column, checks: Column) -> Column:
    """The target mechanically mended for the failed checks; null if nothing changes."""
    numbered = F.when(F.array_contains(checks, "numbers") | target.rlike(r"(?U)(?<=\d),(?=\d)"), restore_numbers(source, target)).otherwise(target)
    # links that agree are left as they are, so no condition is needed
    return F.nullif(X.let({"n": numbered}, lambda n: restore_links(source, n)), target)


def same_links(source: Column, target: Column) -> Column:
    return X.matches(source, X.LINK) == X.matches(target, X.LINK)


def same_citations(source: Column, target: Column) -> Column:
    return X.matches(source, X.CITATION) == X.matches(target, X.CITATION)


def rules_pass(source: Column, target: Column, lexicon: R.Lexicon) -> Column:
    """Whether no rule of the unit fails, and links and citations are the source's, in order. Numbers are compared by presence, so a
    citation changed to a number that the text has anyway would not show there."""
    return ~F.exists(R.unit_rules(source, target, lexicon), lambda i: i["severity"] == "FAIL") & same_links(source, target) & same_citations(source, target)


def accepted(units: DataFrame, candidates: DataFrame, terms: list[Term], lexicon: R.Lexicon) -> DataFrame:
    """candidates (doc_id, unit_id, text) that raise no FAIL by themselves and keep the links and citations. Exceptions and the other
    rules of whole documents are not asked."""
    pairs = with_matches(translated_pairs(units, candidates.select("doc_id", "unit_id", "text", F.lit("ok").alias("status"))).where("target is not null"), terms)
    lost = missing_terms(pairs, terms).select("doc_id", "unit_id").distinct()
    return pairs.where(rules_pass(F.col("text"), F.col("target"), lexicon)).join(lost, ["doc_id", "unit_id"], "left_anti").select("doc_id", "unit_id", F.col("target").alias("text"))


def repair_targets(units: DataFrame, translations: DataFrame, issues: DataFrame) -> DataFrame:
    """doc_id, unit_id, checks, messages: units with a FAIL, and in documents whose links fail, units whose links differ."""
    fails = issues.where("severity = 'FAIL'")
    by_unit = fails.where("unit_id <> '-'").groupBy("doc_id", "unit_id").agg(F.collect_set("check").alias("own"), F.array_sort(F.collect_list(F.concat("check", F.lit(": "), "message"))).alias("messages"))
    by_doc = fails.where("unit_id = '-'").groupBy("doc_id").agg(F.array_sort(F.collect_set("check")).alias("doc_checks"))
    there = units.where("translate").select("doc_id", "unit_id", F.col("text").alias("source"))
    text = translations.select("doc_id", "unit_id", F.col("text").alias("target"))
    none = F.array().cast("array<string>")
    rows = there.join(text, ["doc_id", "unit_id"], "left").join(by_unit, ["doc_id", "unit_id"], "left").join(by_doc, "doc_id", "left")
    rows = rows.withColumns({"own": F.coalesce("own", none), "doc_checks": F.coalesce("doc_checks", none), "target": F.coalesce("target", F.lit(""))})
    wanted = rows.where((F.size("own") > 0) | (F.array_contains("doc_checks", "links") & ~same_links(F.col("source"), F.col("target"))))
    messages = F.when(F.size("own") > 0, F.col("messages")).otherwise(F.transform("doc_checks", lambda c: F.concat(c, F.lit(": paper-level"))))
    return wanted.select("doc_id", "unit_id", "source", "target", F.array_union("own", "doc_checks").alias("checks"), messages.alias("messages"))


def overlay(translations: DataFrame, changes: DataFrame) -> DataFrame:
    """translations with changed rows in place of theirs, and new ones added. Both have the columns of translations."""
    keys = ["doc_id", "unit_id"]
    rest = [c for c in translations.columns if c not in keys]
    a = translations.select(*keys, F.struct(*rest).alias("old"))
    b = changes.select(*keys, F.struct(*rest).alias("new"))
    return a.join(b, keys, "full").select(*keys, F.coalesce("new", "old").alias("row")).select(*keys, "row.*").select(*translations.columns)


def result(rows: DataFrame, status: str, text: str, error: Column | None = None, repaired: str | None = None) -> DataFrame:
    null = F.lit(None).cast("string")
    return rows.select("doc_id", "unit_id", F.lit(status).alias("status"), F.col(text).alias("text"), (null if error is None else error).alias("error"), F.lit(repaired).cast("string").alias("repaired"), F.lit(None).cast("boolean").alias("manual"))


def manual_fix(units: DataFrame, translations: DataFrame, fixes: DataFrame) -> DataFrame:
    """translations with fixes (doc_id, unit_id, text) laid over, marked manual; a fix whose placeholders differ from its unit's
    fails the job."""
    rows = fixes.join(units.select("doc_id", "unit_id", F.col("text").alias("source")), ["doc_id", "unit_id"])
    wrong = X.placeholder_error(F.col("text"), F.col("source"))
    checked = F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(F.col("text"))
    null = F.lit(None).cast("string")
    changes = rows.select("doc_id", "unit_id", F.lit("ok").alias("status"), checked.alias("text"), null.alias("error"), null.alias("repaired"), F.lit(True).alias("manual"))
    return overlay(translations, changes)


def repair_round(units: DataFrame, translations: DataFrame, issues: DataFrame, terms: list[Term], lexicon: R.Lexicon, drafts: Callable[[DataFrame], DataFrame] | None) -> tuple[DataFrame, DataFrame]:
    """(translations after a round, its outcome per target: doc_id, unit_id, fixed). Mechanical fixes come first; drafts turns the
    targets left (doc_id, unit_id, source, target, messages) into doc_id, unit_id, draft, error."""
    keys = ["doc_id", "unit_id"]
    targets = repair_targets(units, translations, issues)
    mended = targets.withColumn("text", mechanical(F.col("source"), F.col("target"), F.col("checks"))).where("text is not null").select(*keys, "text")
    good = accepted(units, mended, terms, lexicon)
    changes = [result(good, "ok", "text", repaired="mechanical")]
    left = targets.join(good, keys, "left_anti")
    if drafts is None:
        changes.append(result(left, "needs_repair", "target", F.array_join("messages", "; ")))
    else:
        drafted = left.join(drafts(left), keys, "left")
        bad = F.coalesce(F.col("error"), X.placeholder_error(F.col("draft"), F.col("source")), F.when(F.col("draft").isNull(), F.lit("no draft")))
        drafted = drafted.withColumn("bad", bad)
        fine = accepted(units, drafted.where("bad is null").select(*keys, F.col("draft").alias("text")), terms, lexicon)
        changes.append(result(fine, "ok", "text", repaired="llm"))
        refused = drafted.join(fine, keys, "left_anti").withColumns({"text": F.when(F.col("bad").isNull(), F.col("draft")).otherwise(F.col("target")), "why": F.coalesce("bad", F.array_join("messages", "; "))})
        changes.append(result(refused, "needs_repair", "text", F.col("why")))
    all_changes = changes[0]
    for c in changes[1:]:
        all_changes = all_changes.unionByName(c)
    return overlay(translations, all_changes), all_changes.select(*keys, (F.col("status") == "ok").alias("fixed"))


def downgraded(translations: DataFrame, issues: DataFrame) -> DataFrame:
    """translations in which units that still fail lose their ok."""
    failing = issues.where("severity = 'FAIL' and unit_id <> '-'").select("doc_id", "unit_id").distinct().withColumn("bad", F.lit(True))
    rows = translations.join(failing, ["doc_id", "unit_id"], "left")
    hit = F.coalesce("bad", F.lit(False)) & (F.col("status") == "ok")
    return rows.withColumns({"status": F.when(hit, "needs_repair").otherwise(F.col("status")), "error": F.when(hit, "still failing after repair").otherwise(F.col("error"))}).select(*translations.columns)


def repair(units: DataFrame, translations: DataFrame, verify: Callable[[DataFrame], DataFrame], terms: list[Term], lexicon: R.Lexicon, drafts=None, cut: Callable[[DataFrame], DataFrame] = cut) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(translations, report, leftover) after at most ROUNDS rounds. verify: translations -> issues. report: round, doc_id, unit_id,
    fixed. leftover: doc_id, unit_id that still need a hand. cut writes a table, so that a round's plan does not grow."""
    report = None
    for k in range(1, ROUNDS + 1):
        issues = cut(verify(translations))
        if issues.where("severity = 'FAIL'").isEmpty():
            break
        translations, outcome = repair_round(units, translations, issues, terms, lexicon, drafts)
        translations, outcome = cut(translations), cut(outcome).withColumn("round", F.lit(k))
        report = outcome if report is None else report.unionByName(outcome)
        if outcome.isEmpty():
            break
    final = cut(downgraded(translations, cut(verify(translations))))
    leftover = final.where("status <> 'ok'").select("doc_id", "unit_id")
    if report is None:
        report = leftover.limit(0).withColumns({"fixed": F.lit(True), "round": F.lit(0)})
    return final, report.select("round", "doc_id", "unit_id", "fixed"), leftover
