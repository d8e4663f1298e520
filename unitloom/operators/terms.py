"""Glossary terms in ordered units: matching, presence in a translation, first mentions, abbreviations, prompt state."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..schemas import MATCHES
from ..session import bounded_batches, slices


@dataclass(frozen=True)
class Term:
    """label: its name. en: source form, then abbreviations. ru: target forms; ru_raw: the target cell as written. gloss: a
    remark wanted at first use. paren_en: 'first' if first use carries the source form in parentheses, else 'never'."""

    label: str
    en: tuple[str, ...]
    ru: tuple[str, ...] = ()
    ru_raw: str = ""
    gloss: str = ""
    paren_en: str = "first"
    note: str = field(default="", compare=False)

    @property
    def abbreviations(self) -> tuple[str, ...]:
        return tuple(a for a in self.en[1:] if a.isupper())

    @property
    def wants_parenthesis(self) -> bool:
        return self.paren_en == "first" and not self.abbreviations

    @property
    def first_form(self) -> str:
        """What first use should read."""
        if not self.wants_parenthesis:
            return self.ru_raw
        base = self.ru[0] if self.ru else self.ru_raw
        return f"{base} ({self.en[0]}; {self.gloss})" if self.gloss else f"{base} ({self.en[0]})"


def term_matcher(terms: list[Term]):
    """text -> [(label, place)] in order of place: whole words in any case, an ending s or es allowed; longer forms take their
    stretch first. One automaton finds all forms, so the cost does not grow with the number of terms."""
    import re
    from bisect import bisect

    import ahocorasick

    fold = lambda s: "".join(c.lower() if len(c.lower()) == 1 else c for c in s)
    forms = sorted(((form, k) for k, t in enumerate(terms) for form in t.en), key=lambda x: -len(x[0]))
    by_text: dict[str, list[int]] = {}
    for rank, (form, _) in enumerate(forms):
        by_text.setdefault(fold(form), []).append(rank)
    automaton = ahocorasick.Automaton()
    for form, ranks in by_text.items():
        if form:
            automaton.add_word(form, (len(form), ranks))
    automaton.make_automaton()
    word = re.compile(r"\w")

    def end_of(text: str, at: int) -> int | None:
        for ending in ("s", "es", ""):
            stop = at + len(ending)
            if text[at:stop] == ending and not (stop < len(text) and word.match(text[stop])):
                return stop
        return None

    def match(text: str | None) -> list[tuple[str, int]]:
        if not text or not by_text:
            return []
        low = fold(re.sub(r"-{2,}", "-", text.replace("*", "")))
        hits = []
        for last, (size, ranks) in automaton.iter(low):
            start = last + 1 - size
            if start and word.match(low[start - 1]):
                continue
            stop = end_of(low, last + 1)
            if stop is not None:
                hits += [(rank, start, stop) for rank in ranks]
        taken: list[tuple[int, int]] = []  # sorted stretches that do not meet
        first: dict[int, int] = {}
        for rank, start, stop in sorted(hits):
            at = bisect(taken, (start, stop))
            if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < stop):
                continue
            taken.insert(at, (start, stop))
            k = forms[rank][1]
            first[k] = min(start, first.get(k, start))
        return sorted(((terms[k].label, at) for k, at in first.items()), key=lambda x: x[1])

    return match


def with_matches(units: DataFrame, terms: list[Term], text: str = "plain", to: str = "matches") -> DataFrame:
    """units with an array of (label, pos) of the terms in a text column, in order. No shuffle."""
    terms = list(terms)
    schema = T.StructType([*units.schema.fields, T.StructField(to, MATCHES)])
    place = units.columns.index(text)

    def run(batches):
        match = term_matcher(terms)
        kind = pa.list_(pa.struct([("label", pa.string()), ("pos", pa.int32())]))
        for batch in slices(batches):
            found = [[{"label": a, "pos": b} for a, b in match(t)] for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, to])

    bounded_batches(units.sparkSession)
    return units.mapInArrow(run, schema)


def terms_table(units: DataFrame, terms: list[Term]) -> DataFrame:
    """terms as a table, with what the rules need of them worked out: label, head, ru_raw, ru, abbreviations, wants, first_form, gloss."""
    rows = [(t.label, t.en[0], t.ru_raw, list(t.ru), list(t.abbreviations), [a for a in t.en[1:] if a.isupper() or _short(a)], t.wants_parenthesis, t.first_form, t.gloss) for t in terms]
    return units.sparkSession.createDataFrame(rows, "label string, head string, ru_raw string, ru array<string>, caps array<string>, short array<string>, wants boolean, first_form string, gloss string")


def _short(form: str) -> bool:
    import re

    return bool(re.fullmatch(r"[A-Z][A-Za-z0-9]{1,6}", form))


def matched_terms(units: DataFrame, terms: list[Term], keep: list[str], limit: int = 32 << 20, outer: bool = False) -> DataFrame:
    """One row per unit and matched term: keep's columns, pos, and the term's columns. The table of terms is broadcast while its
    strings and rows take at most `limit` bytes; beyond, the join shuffles. With outer, an entry of matches whose label is null gives
    a row without a term."""
    table = terms_table(units, terms)
    if sum(256 + sum(len(x.encode()) for x in (t.label, *t.en, *t.ru, 2 * t.ru_raw, 2 * t.gloss)) for t in terms) <= limit:
        table = F.broadcast(table)
    exploded = units.select(*keep, F.explode("matches").alias("_m")).select(*keep, F.col("_m.label").alias("label"), F.col("_m.pos").alias("pos"))
    if not outer:
        return exploded.join(table, "label")
    # rows without a term are dealt by their unit, lest they all meet in one task where the join shuffles
    keyed = exploded.withColumns({"_term": F.col("label").isNotNull(), "_key": F.coalesce("label", F.concat_ws(":", "doc_id", "unit_id"))}).drop("label")
    return keyed.join(table.withColumns({"_term": F.lit(True), "_key": F.col("label")}), ["_term", "_key"], "left").drop("_term", "_key")


def present(ru: Column, text: Column) -> Column:
    """Whether any of the target forms is in the text, by stems; null for no text."""
    return F.when(text.isNotNull(), form_present(ru, text).isNotNull())


def form_present(ru: Column, text: Column) -> Column:
    """The first of the target forms that is in the text, by stems; else null."""
    return X.let({"low": F.lower(X.plain_marks(text))}, lambda low: F.get(F.filter(ru, lambda alt: X.stems_present(alt, low)), F.lit(0)))


def abbreviation_kept(caps: Column, text: Column) -> Column:
    return F.when((F.size(caps) == 0) & text.isNotNull(), F.lit(False)).otherwise(F.arrays_overlap(caps, X.matches(text, r"(?U)\w+")))


def missing_terms(pairs: DataFrame, terms: list[Term]) -> DataFrame:
    """Issues for terms of a source unit that its translation lacks. pairs: doc_id, unit_id, matches, plain_target, and
    exceptions (array of source heads, may be null)."""
    found = matched_terms(pairs, terms, ["doc_id", "unit_id", "plain_target", "exceptions"])
    lost = ~F.coalesce(F.array_contains("exceptions", F.col("head")), F.lit(False)) & ~abbreviation_kept(F.col("caps"), F.col("plain_target")) & ~present(F.col("ru"), F.col("plain_target"))
    return lost_terms(found, lost)


def parenthesis(head: Column, text: Column) -> Column:
    """Whether text has (head) or (head; ...), in any case."""
    bodies = F.transform(X.matches(text, r"\(([^()]*)\)", 1), lambda b: F.lower(F.trim(F.substring_index(b, ";", 1))))
    return F.array_contains(bodies, F.lower(head))


def mention_columns(text: Column) -> dict[str, Column]:
    """What the rules need to know of a term's place in its translation: form (the first target form present), has_paren, expanded
    (abbreviations that stand in parentheses), glossed. With these the text itself need not be kept, sorted or shuffled."""
    bodies = X.matches(text, r"\(\s*([^()\s]+)\s*\)", 1)
    expanded = F.when(F.size("caps") == 0, F.array().cast("array<string>")).otherwise(F.array_intersect("caps", bodies))
    return {"form": form_present(F.col("ru"), text), "has_paren": parenthesis(F.col("head"), text), "expanded": expanded, "glossed": F.contains(text, F.col("gloss"))}


def term_mentions(pairs: DataFrame, terms: list[Term]) -> DataFrame:
    """doc_id, ordinal, unit_id, pos, label and the term's columns, with those of mention_columns()."""
    found = matched_terms(pairs, terms, ["doc_id", "ordinal", "unit_id", "plain_target"])
    return found.withColumns(mention_columns(F.col("plain_target"))).drop("plain_target")


def lost_terms(rows: DataFrame, lost: Column) -> DataFrame:
    """Issues of the rows (doc_id, unit_id, head, ru_raw) of which lost holds."""
    return rows.where(lost).select("doc_id", "unit_id", F.lit("glossary").alias("check"), F.lit("FAIL").alias("severity"), F.concat(F.lit("term missing: "), "head", F.lit(" → "), "ru_raw").alias("message"))


def unit_findings(pairs: DataFrame, terms: list[Term], issues: Column) -> DataFrame:
    """All that the rules of verification need of pairs, in one pass and without the texts: a row per unit (label null: kind, done,
    issues) and one per mention of a term (term_mentions() with lost). issues: the array that the rules of a unit give."""
    keep = ["doc_id", "ordinal", "unit_id", "kind"]
    mark = F.array(F.struct(F.lit(None).cast("string").alias("label"), F.lit(None).cast("int").alias("pos")))
    rows = pairs.select(*keep, F.col("target").isNotNull().alias("done"), "plain", F.coalesce("plain_target", F.lit("")).alias("plain_target"), "exceptions", F.when(F.col("target").isNotNull(), issues).alias("issues"))
    matched = with_matches(rows, terms).withColumn("matches", F.concat(mark, "matches"))
    found = matched_terms(matched, terms, [*keep, "done", "plain_target", "exceptions", "issues"], outer=True)
    of_term, text = F.col("label").isNotNull(), F.col("plain_target")
    made = {n: F.when(of_term, c) for n, c in mention_columns(text).items()}
    found = found.withColumns(made | {"issues": F.when(~of_term, F.col("issues"))})
    lost = F.col("done") & F.col("form").isNull() & ~F.coalesce(F.array_contains("exceptions", F.col("head")), F.lit(False)) & ~abbreviation_kept(F.col("caps"), text)
    return found.withColumn("lost", F.when(of_term, lost)).drop("plain_target", "exceptions", "ru", "short")


def first_mention_issues(mentions: DataFrame) -> DataFrame:
    """First use of a term in a document must carry its source form (and gloss); later uses must not."""
    w = Window.partitionBy("doc_id", "label").orderBy("ordinal")
    rows = mentions.where("wants").select("doc_id", "unit_id", "ordinal", "label", "head", "first_form", "gloss", "has_paren", "glossed").withColumns({"nth": F.row_number().over(w), "first_unit": F.first("unit_id").over(w)})
    kind = (
        F.when((F.col("nth") == 1) & ~F.col("has_paren"), F.struct(F.lit("first_mention").alias("check"), F.lit("FAIL").alias("severity"), F.concat(F.lit("missing ("), "head", F.lit(") on first use → "), "first_form").alias("message")))
        .when((F.col("nth") == 1) & (F.col("gloss") != "") & ~F.col("glossed"), F.struct(F.lit("gloss").alias("check"), F.lit("WARN").alias("severity"), F.concat(F.lit("missing gloss on first use: "), "gloss").alias("message")))
        .when((F.col("nth") > 1) & F.col("has_paren"), F.struct(F.lit("first_mention").alias("check"), F.lit("WARN").alias("severity"), F.concat(F.lit("("), "head", F.lit(") repeated after "), "first_unit").alias("message")))
    )
    return rows.withColumn("i", kind).where("i is not null").select("doc_id", "unit_id", "i.*")


def abbreviation_issues(mentions: DataFrame) -> DataFrame:
    """An abbreviation expanded a second time, told at the second unit."""
    rows = mentions.select("doc_id", "unit_id", "ordinal", "pos", F.explode("expanded").alias("abbr"))
    w = Window.partitionBy("doc_id", "abbr").orderBy("ordinal", "pos")
    rows = rows.withColumns({"nth": F.row_number().over(w), "first_unit": F.first("unit_id").over(w)}).where("nth = 2")
    return rows.select("doc_id", "unit_id", F.lit("abbrev").alias("check"), F.lit("WARN").alias("severity"), F.concat("abbr", F.lit(" expanded again (first at "), "first_unit", F.lit(")")).alias("message"))


def consistency_issues(mentions: DataFrame) -> DataFrame:
    """Terms with more than one target form in a document."""
    forms = mentions.where("form is not null").groupBy("doc_id", "label").agg(F.array_sort(F.collect_set("form")).alias("forms")).where(F.size("forms") > 1)
    return forms.select("doc_id", F.lit("-").alias("unit_id"), F.lit("glossary").alias("check"), F.lit("FAIL").alias("severity"), F.concat("label", F.lit(": inconsistent forms "), X.listed(F.col("forms"))).alias("message"))


# prompt state ---------------------------------------------------------------------------------------------------------------


def introduced(units: DataFrame, terms: list[Term]) -> DataFrame:
    """units (doc_id, ordinal, unit_id, translate, matches) with, per unit: abbr_first and abbr_known (its abbreviations, new or
    met before), head_first and head_known (source forms that want a parenthesis), glossary (its terms with the form to use)."""
    rows = matched_terms(units, terms, ["doc_id", "ordinal", "unit_id", "translate"])

    def split(values: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy("doc_id", "value")
        seen = values.withColumn("met", F.coalesce(F.min(F.when(F.col("translate"), F.col("ordinal"))).over(w) < F.col("ordinal"), F.lit(False)))
        return seen.groupBy("doc_id", "unit_id").agg(F.array_sort(F.collect_set(F.when(~F.col("met"), F.col("value")))).alias(f"{name}_first"), F.array_sort(F.collect_set(F.when(F.col("met"), F.col("value")))).alias(f"{name}_known"))

    abbr = split(rows.select("doc_id", "ordinal", "unit_id", "translate", F.explode("short").alias("value")), "abbr")
    head = split(rows.where("wants").select("doc_id", "ordinal", "unit_id", "translate", F.col("head").alias("value")), "head")
    w = Window.partitionBy("doc_id", "label")
    met = F.coalesce(F.min(F.when(F.col("translate") & F.col("wants"), F.col("ordinal"))).over(w) < F.col("ordinal"), F.lit(False))
    line = F.concat("label", F.lit(" → "), F.when(~F.col("met") & F.col("wants"), F.col("first_form")).otherwise(F.col("ru_raw")))
    block = rows.withColumn("met", met).groupBy("doc_id", "unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"]), "\n").alias("glossary"))
    out = units
    for part in (abbr, head, block):
        out = out.join(part, ["doc_id", "unit_id"], "left")
    return out
