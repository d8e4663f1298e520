"""The steps from landed articles to a gated, rendered result, as one function over tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import render, repair, translate, verify
from ..operators.terms import Term
from ..session import cut
from ..sources import jats

#: The steps in order.
STEPS = ("digest", "translate", "render", "verify", "repair", "publish")


@dataclass
class Result:
    units: DataFrame
    translations: DataFrame
    issues: DataFrame
    gate: DataFrame
    bodies: DataFrame


def translated(units: DataFrame, translations: DataFrame | None, translator, system: str, terms: list[Term], keep: str | None = None) -> DataFrame:
    """translations brought up to date: units with an ok row are not asked for again. keep: a path where results are kept as they come."""
    todo = translate.prompts(units, terms).where("translate")
    if translations is not None:
        todo = todo.join(translations.where("status = 'ok'").select("doc_id", "unit_id"), ["doc_id", "unit_id"], "left_anti")
    made = translate.translate_kept(todo, translator, system, keep) if keep else translate.translate(todo, translator, system)
    made = made.select("*", F.lit(None).cast("string").alias("repaired"), F.lit(None).cast("boolean").alias("manual"))
    return made if translations is None else repair.overlay(translations, made)


def run(docs: DataFrame, translator, terms: list[Term], lexicon: R.Lexicon, system: str = "", translations: DataFrame | None = None, protected: dict | None = None, keep: str | None = None) -> Result:
    """docs: doc_id, raw (JATS). translator: chat messages -> text. keep: see translated()."""
    units = cut(jats.digest(docs, "raw", protected))
    results = cut(translated(units, translations, translator, system, terms, keep))
    source = cut(render.render(units).withColumnRenamed("body", "body_source"))

    def check(rows: DataFrame) -> DataFrame:
        target = render.render(units, rows).withColumnRenamed("body", "body_target")
        return verify.verify(units, rows, source.join(target, "doc_id"), terms, lexicon)

    results, _, _ = repair.repair(units, results, check, terms, lexicon, cut=cut)
    results = cut(results)
    issues = cut(check(results))
    gate = verify.gate(docs.select("doc_id").distinct(), issues)
    return Result(units, results, issues, gate, render.render(units, results).join(verify.publishable(gate), "doc_id", "left_semi"))
