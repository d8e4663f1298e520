"""The catalogue: reading time, titles, records, search, sorting, facets, status, and the marks of a rendered page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut
from .render import plain_title

WORDS_A_MINUTE = 120


def reading_minutes(body: Column) -> Column:
    """Minutes to read a Markdown body, at least 1; halves go to the even minute."""
    text = F.coalesce(body, F.lit(""))
    for pattern, to in ((r"(?s)```.*?```", " "), (r"!\[[^\]]*\]\([^)]*\)", " "), (r"\[([^\]]+)\]\([^)]*\)", "$1"), (r"(?mU)^#{1,6}\s+", ""), (r"(?mU)^>\s?", ""), (r"[*_`#|]", " ")):
        text = F.regexp_replace(text, pattern, to)
    words = F.regexp_count(text, F.lit(r"(?U)\S+"))
    return F.greatest(F.lit(1), F.bround(words / WORDS_A_MINUTE)).cast("int")


def split_title(body: Column, fallback: Column) -> Column:
    """struct(title, body): the first level-1 heading and what is left without its line; else the fallback and the body."""
    pattern = r"(?m)^# (.*)$"
    has = body.rlike(pattern)
    rest = F.regexp_replace(F.concat(F.regexp_extract(body, r"(?s)\A((?:(?!# )[^\n]*\n)*)# [^\n]*", 1), F.regexp_extract(body, r"(?s)\A(?:(?!# )[^\n]*\n)*# [^\n]*\n?(.*)\z", 1)), r"^\n+", "")
    return F.struct(
        F.when(has, plain_title(F.regexp_extract(body, pattern, 1))).otherwise(plain_title(F.coalesce(fallback, F.lit("")))).alias("title"), F.when(has, rest).otherwise(F.regexp_replace(body, r"^\n+", "")).alias("body")
    )


def split_note(body: Column) -> Column:
    """struct(note, body): the leading block quotation without its marks, and the rest."""
    quoted = F.regexp_extract(body, r"\A((?:>[^\n]*(?:\n|\z))*)", 1)
    lines = F.filter(F.split(quoted, "\n", -1), lambda x: F.startswith(x, F.lit(">")))
    note = F.array_join(F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, "^[> ]+", ""), r"(?U)\s+$", "")), "\n")
    return F.struct(note.alias("note"), F.regexp_replace(F.substring(body, F.length(quoted) + 1, F.length(body)), r"^\n+", "").alias("body"))


def difficulty_label(level: Column, note: Column) -> Column:
    """Null without a level; a blank note counts as none."""
    base, told = F.format_string("Сложность %d/10.", level), F.regexp_replace(F.coalesce(note, F.lit("")), r"(?U)^\s+|\s+$", "")
    return F.when(level.isNotNull(), F.when(told != "", F.concat(base, F.lit(" "), told)).otherwise(base))


def difficulty_chip(level: Column, note: Column) -> Column:
    return F.concat(F.lit('<span class="difficulty-chip">'), X.html_escape(difficulty_label(level, note)), F.lit("</span>"))


def topic_chips(topics: Column, between: str = " ") -> Column:
    return F.array_join(F.transform(F.coalesce(topics, F.array().cast("array<string>")), lambda t: F.concat(F.lit('<span class="topic-chip">'), X.html_escape(t), F.lit("</span>"))), between)


def records(papers: DataFrame) -> DataFrame:
    """Catalogue records of papers (slug, title, authors, year, topics, difficulty, body)."""
    rows = papers.withColumn("_s", split_title(F.col("body"), F.col("title")))
    return rows.select(
        "slug", F.col("_s.title").alias("title_ru"), "title", F.array_join("authors", ", ").alias("authors"), F.col("year").cast("int").alias("year"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        F.col("difficulty").cast("int").alias("difficulty"), reading_minutes(F.col("_s.body")).alias("reading_minutes"),
    )


def haystack() -> Column:
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.lower(F.concat_ws(" ", part("title_ru"), part("title"), part("authors"), part("year"), part("slug"), F.array_join("topics", " ")))


def search(catalog: DataFrame, query: str, top: int | None = 8) -> DataFrame:
    """Records that contain the query, in catalogue order, the first `top` of them; an empty query finds none."""
    q = query.strip().lower()
    hits = newest_first(catalog.where(F.contains(haystack(), F.lit(q)) if q else F.lit(False)))
    return hits if top is None else hits.limit(top)


def listing(catalog: DataFrame, query: str = "", topics: list[str] = ()) -> DataFrame:
    """Records shown in the index: those that contain the query (all, if it is empty) and have every selected topic."""
    q = query.strip().lower()
    rows = catalog.where(F.contains(haystack(), F.lit(q))) if q else catalog
    return rows.where(F.size(F.array_except(F.array(*map(F.lit, topics)), "topics")) == 0) if topics else rows


def newest_first(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy(F.desc(F.coalesce("year", F.lit(0))), "slug")


def ordered(catalog: DataFrame, mode: str) -> DataFrame:
    """year-asc, year-desc (year): ties by slug. difficulty-asc, difficulty-desc: ties in catalogue order. Nulls last either way."""
    return catalog.orderBy(*_keys(mode))


def _keys(mode: str) -> list[Column]:
    axis, _, way = ("year-desc" if mode == "year" else mode).partition("-")
    key = F.asc_nulls_last(axis) if way == "asc" else F.desc_nulls_last(axis)
    return [key, F.asc("slug")] if axis == "year" else [key, F.desc(F.coalesce("year", F.lit(0))), F.asc("slug")]


def placed(catalog: DataFrame, mode: str) -> DataFrame:
    """ordered() with each record's place from 1. Rows are dealt to ranges of the order and numbered in them; only the ranges'
    sizes meet in one window."""
    ranges = cut(catalog.repartitionByRange(*_keys(mode)).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_before"))
    rows = ranges.join(F.broadcast(starts), "_range").withColumn("place", F.row_number().over(Window.partitionBy("_range").orderBy(*_keys(mode))) + F.col("_before"))
    return rows.drop("_range", "_before")


def facets(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.explode("topics").alias("topic")).distinct().orderBy("topic")


def status_table(meta: DataFrame, state: DataFrame) -> DataFrame:
    """slug, status, last_step, exit_code of every paper with a proper slug; defaults where there is no state."""
    rows = meta.where(X.valid_slug(F.col("slug"))).join(state.select("slug", "last_step", F.col("exit_code").cast("string").alias("exit_code")), "slug", "left")
    return rows.select("slug", F.coalesce("status", F.lit("not-started")).alias("status"), F.coalesce("last_step", F.lit("-")).alias("last_step"), F.coalesce("exit_code", F.lit("-")).alias("exit_code")).orderBy("slug")


def status_line() -> Column:
    return F.concat(F.rpad("slug", 24, " "), F.lit(" "), F.rpad("status", 22, " "), F.lit(" "), F.rpad("last_step", 14, " "), F.lit(" "), F.col("exit_code"))


# marks of a rendered page ----------------------------------------------------------------------------------------------

# Shapes in rendered HTML.
ANCHOR = r"(?si)<a\b[^>]*>.*?</a>"
REFERENCES = r'(?s)<ol class="references">.*?</ol>'
CITED = r"\[\d+(?:\s*[,–-]\s*\d+)*\]"
CAPTION = r"<strong>(?:Рис|Fig|Таблица)\.? [^<]*</strong>.*?"


def woven(text: Column, pattern: str, inside, outside) -> Column:
    """Matches and what lies between them, each changed in its own way, in order."""
    bound = lambda pieces, found: X.let({"p": F.transform(pieces, lambda x: outside(x)), "f": F.transform(found, lambda x: inside(x))}, X.woven)
    return X.let({"pieces": F.split(text, pattern, -1), "found": X.matches(text, pattern)}, bound)


def same(x: Column) -> Column:
    return x


def outside_anchors(text: Column, change) -> Column:
    return woven(text, ANCHOR, same, change)


def link_citations(body: Column) -> Column:
    """Numbers of [n] groups as links to the references, but not within links."""
    link = lambda group: F.regexp_replace(group, r"(\d+)", '<a href="#ref-$1" class="cite">$1</a>')
    return outside_anchors(body, lambda part: woven(part, CITED, link, same))


def link_dois(body: Column) -> Column:
    """doi: tokens of the reference list as links."""
    token = lambda part: F.regexp_replace(part, r"(?i)doi:(10\.\d+/[^\s<]+)", '<a href="https://doi.org/$1">doi:$1</a>')
    return woven(body, REFERENCES, lambda ol: outside_anchors(ol, token), same)


def anchor_references(body: Column) -> Column:
    """ref-N ids on the items of the reference list; an item with an id keeps it but counts."""

    item = r"(?i)<li\b[^>]*>"
    named = lambda li, i: F.when(li.rlike(r"(?i)\bid\s*="), li).otherwise(F.concat(F.lit('<li id="ref-'), (i + 1).cast("string"), F.lit('"'), F.substring(li, F.lit(4), F.length(li))))

    def numbered(ol: Column) -> Column:
        return X.let({"pieces": F.split(ol, item, -1), "tags": F.transform(X.matches(ol, item), named)}, X.woven)

    return woven(body, REFERENCES, numbered, same)


def lazy_images(body: Column) -> Column:
    late = lambda img: F.when(img.rlike(r"(?i)\bloading\s*="), img).otherwise(F.concat(F.lit('<img loading="lazy" decoding="async"'), F.substring(img, F.lit(5), F.length(img))))
    return woven(body, r"(?i)<img\b[^>]*>", late, same)


def figure_boxes(body: Column) -> Column:
    """A figure and the caption after it, or a caption alone, in a box."""
    boxed = F.regexp_replace(body, rf"(?s)<figure>\s*(<img\b[^>]*>)\s*(?:<figcaption[^>]*>.*?</figcaption>\s*)?</figure>\s*<p>({CAPTION})</p>", '<div class="figure-box"><p>$1</p><p>$2</p></div>')
    alone = lambda part: F.regexp_replace(part, rf"(?s)<p>({CAPTION})</p>", '<div class="figure-box"><p>$1</p></div>')
    return woven(boxed, r'(?s)<div class="figure-box">.*?</div>', same, alone)


def decorate(pages: DataFrame, body: str) -> DataFrame:
    """All marks on a column, in order; a projection for each, as one expression would nest too deep."""
    listed = lambda c: F.regexp_replace(c, r"(<h2>Список литературы</h2>\s*)<ol[^>]*>", '$1<ol class="references">')
    for mark in (figure_boxes, lazy_images, listed, anchor_references, link_dois, link_citations):
        pages = pages.withColumn(body, mark(F.col(body)))
    return pages
