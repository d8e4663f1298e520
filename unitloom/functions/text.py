"""Scalar text functions: Column -> Column, all in the JVM. (?U) makes \\w, \\d, \\b and \\s cover all scripts, (?iu) folds their case."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that results depend on.
PLACEHOLDER = r"⟦[A-Z]\d+⟧"
NUMBER = r"(?U)(?=[\d−-])(?<![\w.])[−-]?\d+(?:[.,]\d+)*(?:[–-]\d+(?:[.,]\d+)*)?%?"
LINK = r"(?U)https?://[^\s)\]>]+|doi:\s*10\.\d{4,9}/\S+"
IMAGE = r"!\[[^\]]*\]\(assets/([^)\s]+)\)"
CITATION = r"(?U)\[\d+(?:\s*[,–-]\s*\d+)*\]"
SENTENCE_END = r"(?U)(?<=[.!?])\s+"
WORD = r"(?U)[\w]+"
#: What (?U)\\s matches, for trimming without a pattern.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SLUG = r"^\d{4}-[a-z0-9]+(?:-[a-z0-9]+)*$"


def literal(text: str) -> str:
    """A Java pattern for exactly this text."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def let(values: dict[str, Column], body) -> Column:
    """body over values that are worked out once. Inside a higher-order function an outer expression would be worked out anew
    for each element; bound here it is a variable."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), lambda s: body(*[s[n] for n in values])), F.lit(0))


def woven(pieces: Column, between: Column) -> Column:
    """Pieces of a split with an array's elements between them, in order."""
    return F.array_join(F.transform(pieces, lambda x, i: F.concat(x, F.coalesce(F.get(between, i), F.lit("")))), "")


def listed(values: Column) -> Column:
    """Strings as a bracketed, quoted list."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


# placeholders ------------------------------------------------------------------------------------------------------------


def placeholders(text: Column) -> Column:
    return matches(text, PLACEHOLDER)


def where_any(text: Column, signs: tuple[str, ...], change) -> Column:
    """change(text) where one of the signs is in it, which is far cheaper to see than what a pattern finds; else text as it is."""
    has = lambda t: reduce(lambda a, b: a | b, (F.contains(t, F.lit(s)) for s in signs))
    return let({"t": text}, lambda t: F.when(has(t), change(t)).otherwise(t))


def strip_placeholders(text: Column) -> Column:
    return where_any(text, ("⟦",), lambda t: F.regexp_replace(t, PLACEHOLDER, " "))


def collapse(text: Column) -> Column:
    """Runs of space, tab and line ends to one space; no-break and thin spaces stay."""
    return F.regexp_replace(text, r"[ \t\r\n]+", " ")


def finish(text: Column) -> Column:
    """Spaces around display formulas trimmed, and the ends."""
    return F.btrim(where_any(text, ("\n\n$$",), lambda t: F.regexp_replace(t, r"(?s) *(\n\n\$\$.*?\$\$\n\n) *", "$1")), F.lit(SPACES))


def unmask(text: Column, spans: Column, titles: Column | None = None) -> Column:
    """Placeholders replaced by their Markdown, in one pass over the pieces between them; a section reference by its title, if
    titles (a map from id) has it; unknown placeholders stay."""
    def restored(keys: Column, pieces: Column) -> Column:
        return let({"held": F.transform(keys, lambda p: _resolved(p, spans, titles))}, lambda held: woven(pieces, held))

    return finish(F.when(F.contains(text, F.lit("⟦")), let({"keys": placeholders(text), "pieces": F.split(text, PLACEHOLDER, -1)}, restored)).otherwise(text))


def _resolved(key: Column, spans: Column, titles: Column | None) -> Column:
    span = F.try_element_at(spans, key)
    md = span["md"]
    if titles is not None:
        md = F.when(span["type"] == "R", F.coalesce(F.try_element_at(titles, F.coalesce(span["rid"], F.lit(""))), md)).otherwise(md)
    return F.coalesce(md, key)


def unmask_strict(text: Column, spans: Column, titles: Column | None = None) -> Column:
    """unmask(), failing on a placeholder that spans lacks."""
    unknown = F.filter(placeholders(text), lambda p: F.try_element_at(spans, p).isNull())
    return F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown placeholder "), F.get(unknown, F.lit(0))))).otherwise(unmask(text, spans, titles))


def placeholder_error(translated: Column, source: Column) -> Column:
    """Null if both hold the same bag of placeholders, else what is wrong: unknown ones before duplicated before missing."""
    times = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    told = lambda what, arr: F.concat(F.lit(f"{what} placeholders: "), F.array_join(arr, " "))

    def judged(got: Column, want: Column) -> Column:
        unknown = F.array_sort(F.array_except(got, want))
        twice = F.array_sort(F.array_distinct(F.filter(got, lambda x: times(got, x) > times(want, x))))
        gone = F.array_sort(F.array_distinct(F.filter(want, lambda x: times(got, x) < times(want, x))))
        return F.when(F.array_sort(got) == F.array_sort(want), None).when(F.size(unknown) > 0, told("unknown", unknown)).when(F.size(twice) > 0, told("duplicated", twice)).otherwise(told("missing", gone))

    return let({"got": placeholders(translated), "want": placeholders(source)}, judged)


def mask_protected(text: Column, terms: list[str], patterns: list[str] = ()) -> Column:
    """struct(text, spans): protected terms (longest first, whole words) and patterns replaced by numbered ⟦Nk⟧."""
    alternatives = [literal(t) for t in sorted(terms, key=len, reverse=True)] + list(patterns)
    clean = collapse(text)
    if not alternatives:
        return F.struct(clean.alias("text"), F.create_map().cast("map<string,struct<type:string,md:string,rid:string>>").alias("spans"))
    protected = r"(?U)(?<!\w)(?:" + "|".join(alternatives) + r")(?!\w)"
    key = lambda i: F.concat(F.lit("⟦N"), (i + 1).cast("string"), F.lit("⟧"))

    def made(found: Column, pieces: Column) -> Column:
        masked = F.array_join(F.transform(pieces, lambda x, i: F.concat(x, F.when(i < F.size(found), key(i)).otherwise(""))), "")
        spans = F.map_from_entries(F.transform(found, lambda x, i: F.struct(key(i).alias("key"), F.struct(F.lit("N").alias("type"), x.alias("md"), F.lit(None).cast("string").alias("rid")).alias("value"))))
        return F.struct(masked.alias("text"), spans.alias("spans"))

    return let({"found": matches(clean, protected), "pieces": F.split(clean, protected, -1)}, made)


# numbers -----------------------------------------------------------------------------------------------------------------


def normal_numbers(text: Column, target: bool) -> Column:
    """Numbers in one notation: rare spaces plain, '5 %' closed up, thousands joined (commas in a source, spaces in a target). The
    patterns ask for their rarest character first."""
    t = where_any(strip_placeholders(text), ("\u00a0", "\u2009", "\u202f"), lambda t: F.regexp_replace(t, r"[\u00a0\u2009\u202f]", " "))
    if target:
        return F.regexp_replace(t, r"(?U) (?<=\d )(?=%|\d{3}\b)", "")
    return where_any(t, (" %", ","), lambda t: F.regexp_replace(t, r"(?U)[ ,](?:(?<=\d )(?=%)|(?<=\d,)(?=\d{3}\b))", ""))


def number_tokens(text: Column, target: bool = False) -> Column:
    return matches(normal_numbers(text, target), NUMBER)


def decimal_points(text: Column) -> Column:
    """Commas between digits to points."""
    return F.regexp_replace(text, r"(?U),(?<=\d,)(?=\d)", ".")


# sentences, words, stems -----------------------------------------------------------------------------------------------


def sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), SENTENCE_END, -1)


def last_sentences(text: Column, n: int = 2) -> Column:
    return let({"s": sentences(text)}, lambda s: F.array_join(F.slice(s, F.greatest(F.lit(1), F.size(s) - n + 1), F.lit(n)), " "))


def plain_marks(text: Column) -> Column:
    """Emphasis asterisks dropped, dashes of several hyphens as one."""
    return where_any(F.replace(text, F.lit("*"), F.lit("")), ("--",), lambda t: F.regexp_replace(t, "-{2,}", "-"))


def stem(word: Column) -> Column:
    """The prefix that inflected forms share: two letters less from five on, one less of four."""
    w = F.lower(word)
    return F.when(F.length(w) >= 5, w.substr(F.lit(1), F.length(w) - 2)).when(F.length(w) == 4, w.substr(F.lit(1), F.lit(3))).otherwise(w)


def whole_word(term: str) -> str:
    """Pattern of a term as a whole word in any case, with a plural ending or none."""
    return r"(?iuU)(?<!\w)" + literal(term) + r"(?:s|es)?(?!\w)"


def stems_present(alternative: Column, low: Column) -> Column:
    """Whether each word of the alternative has a word in low (lower case, plain marks) that starts with its stem. Stems are letters
    and digits only, so they need no quoting in a pattern, which is asked only where the stem is in the text at all."""
    return F.forall(F.transform(matches(alternative, WORD), stem), lambda s: F.contains(low, s) & F.rlike(low, F.concat(F.lit(r"(?U)(?<!\w)"), s)))


def all_stems_present(alternative: Column, text: Column) -> Column:
    """Whether each word of the alternative has a word in text that starts with its stem."""
    return let({"low": F.lower(plain_marks(text))}, lambda low: stems_present(alternative, low))


def is_upper(text: Column) -> Column:
    """Has cased letters, all of them capitals."""
    return (text == F.upper(text)) & (text != F.lower(text))


# Markdown and HTML --------------------------------------------------------------------------------------------------------


def html_escape(text: Column, quotes: bool = True) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *((('"', "&quot;"), ("'", "&#x27;")) if quotes else ())):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def clean_url(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"(?U)^\s+|\s+$", ""), r"(?i)(?:%3e|>)+$", "")


def tex(raw: Column) -> Column:
    """The formula between $$ or $ signs, trimmed; null if there is none."""
    pattern = r"(?s)\$\$(.*?)\$\$|\$(.*?)\$"
    inner = F.concat(F.regexp_extract(raw, pattern, 1), F.regexp_extract(raw, pattern, 2))
    return F.when(raw.rlike(pattern), F.regexp_replace(inner, r"(?U)^\s+|\s+$", ""))


def html_text(html: Column) -> Column:
    """Text of a fragment: br as a space, tags dropped, white space collapsed."""
    return F.trim(collapse(F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>", " "), "<[^>]*>", "")))


def valid_slug(slug: Column) -> Column:
    return F.coalesce(slug.rlike(SLUG), F.lit(False))
