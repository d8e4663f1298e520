"""Robust multivariate outliers among documents: minimum covariance determinant per language and source, in SQL functions only.

Estimates are nested: one of all documents, of each language, and of each language and source. Each is found from several starts by
concentration steps until its determinant no longer falls, and the start with the least determinant counts. Then a language's is
shrunk towards that of all, and a source's towards its language's.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Scratch, small_broadcast

WINDOW = 8
P = 4
#: Vector components are kept in units of 1 / SCALE, an eighth of the least floor: sums are of whole numbers and don't hang on their
#: order, and a stratum of any size has few different vectors.
SCALE = 256
#: Steps of a histogram of log squared distances, to one unit of the logarithm.
BINS = 32
#: Key of an estimate over all values of a column; values of the tables are '' (null) or begin with '='.
ANY = "*"
STARTS = ("box", "mean", "median")


@dataclass(frozen=True)
class McdSpec:
    """part: share of a stratum's rows that the determinant is minimised over. steps: concentration steps at most (they end when no
    determinant falls). shrink: rows that the estimate one level up counts for: of a stratum of n rows its own estimate has the weight
    n / (n + shrink). tail: chance that a clean Gaussian document lies beyond the cutoff: one in a hundred million, so that even a
    corpus of billions loses a few dozen. smooth: words of ordinary text added to each text, so that short ones scatter less.
    floors: standard deviations added to each component (log word length; square roots of the shares of symbols, repeated lines
    and repeated words): about the sampling errors 1 / (2 sqrt(m)) of the shortest texts that pass the base rule (20 words and
    the smoothing: m = 350 characters, 6 to 25 lines, 25 to 70 words), without which strata where a share is always 0 would reject
    the first text that has one."""

    part: float = 0.75
    steps: int = 8
    shrink: float = 50.0
    tail: float = 1e-8
    floors: tuple[float, ...] = (0.03, 0.03, 0.1, 0.1)
    smooth: int = 50


def chi2_tail(x: float, df: int) -> float:
    """P(chi-square with an even number df of degrees > x)."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_point(tail: float, df: int) -> float:
    lo, hi = 0.0, 2000.0
    for _ in range(200):
        lo, hi = ((lo + hi) / 2, hi) if chi2_tail((lo + hi) / 2, df) > tail else (lo, (lo + hi) / 2)
    return lo


def consistency(part: float) -> float:
    """Factor that makes the covariance of the nearest `part` of Gaussian rows unbiased."""
    return part / (1 - chi2_tail(chi2_point(1 - part, P), P + 2))


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words in WINDOW-word windows that occur twice or more. Texts whose window hashes differ are done; of the others, windows with a
    hash that occurs again are compared themselves, and the places of equal ones merged."""

    def twins(s: Column, same, place) -> Column:
        """Places of the elements of a sorted array that equal a neighbour, ascending."""
        twice = F.transform(s, lambda e, j: F.when(((j > 0) & (same(F.get(s, j - 1)) == same(e))) | (same(F.get(s, j + 1)) == same(e)), place(e)))
        return F.array_sort(F.filter(twice, lambda i: i.isNotNull()))

    def covered(s: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
        add = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["total"] + i + WINDOW - F.greatest(a["end"], i)).alias("total"))
        return F.aggregate(twins(s, lambda e: e["w"], lambda e: e["i"]), start, add, lambda a: a["total"])

    def compared(s: Column) -> Column:
        windows = F.transform(twins(s, lambda e: e["h"], lambda e: e["i"]), lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("w"), i.alias("i")))
        return bound(F.sort_array(windows), covered)

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(F.sort_array(placed), compared)).cast("long")


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with _lang and _source ('' for null, else '=' and the value) and _row1, _row2: 128 bits of hash over all that a row's
    verdict hangs on, its text, language and source."""
    rows = docs.select("*", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(f"_{c}") for c in ("lang", "source")])
    body = F.col(text).cast("string")
    return rows.select("*", *[F.xxhash64(F.lit(k), F.col("_lang"), F.col("_source"), body.isNull(), body).alias(f"_row{k}") for k in (1, 2)])


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' doc_id, lang and source keys, row1, row2 and the base statistics; see row_keys and robust_outliers."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = row_keys(docs.select("doc_id", "lang", "source", text), text).select(
        "doc_id", F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("_row1").alias("row1"), F.col("_row2").alias("row2"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("_words"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    rows = rows.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    h = F.col("_hash")
    windows = F.when(F.size("_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_windows", windows)
    return rows.select(
        "doc_id", "lang", "source", "row1", "row2",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words"), F.col("_windows")).alias("n_repeat_words"),
    )


BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def number(x: float) -> str:
    """A double literal that every SQL engine reads alike."""
    return f"cast('{float(x)!r}' as double)"


def vector(spec: McdSpec) -> list[tuple[str, str]]:
    """The transformed statistics as whole numbers q1..q4; smoothed by a few words of ordinary text, so that short texts scatter less."""
    k = spec.smooth
    share = lambda a, b: f"{number(a[1])} + {a[0]}) / ({number(b[1])} + {b[0]})"
    shares = (f"ln(({share(('word_chars', 5 * k), ('n_words', k))})", f"sqrt(({share(('n_symbols', 0), ('word_chars', k))})", f"sqrt(({share(('n_dup_lines', 0), ('n_lines', 5))})", f"sqrt(({share(('n_repeat_words', 0), ('n_words', k))})")
    return [(f"q{i}", f"cast(floor({x} * {number(SCALE)} + {number(0.5)}) as bigint)") for i, x in enumerate(shares, 1)]


def distance() -> list[tuple[str, str]]:
    """Squared Mahalanobis distance d2 from q, the centre m and the Cholesky factor l, by forward substitution."""
    steps = [(f"y{i}", f"(q{i} - m{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(1, i)) + f") / l{i}{i}") for i in range(1, P + 1)]
    return [*steps, ("d2", " + ".join(f"y{i} * y{i}" for i in range(1, P + 1))), ("bin", f"cast(floor(ln(d2 + {number(0.0001)}) * {number(BINS)}) as bigint)")]


PAIRS = [(i, j) for i in range(1, P + 1) for j in range(1, i + 1)]
Q = [f"q{i}" for i in range(1, P + 1)]
KEYS = ["lang", "source"]
MOMENTS = [*(f"s{i}" for i in range(1, P + 1)), *(f"s{i}{j}" for i, j in PAIRS)]
PRIOR = [*(f"m{i}" for i in range(1, P + 1)), *(f"c{i}{j}" for i, j in PAIRS)]
NAMES = [*PRIOR, *(f"l{i}{j}" for i, j in PAIRS), "det"]


def sums() -> list[tuple[str, str]]:
    """Exact sums of counted cells: rows, components and products."""
    whole = lambda x: f"sum(cast({x} as decimal(28, 0)))"
    return [("n", "sum(cast(n as bigint))"), *((f"s{i}", whole(f"n * q{i}")) for i in range(1, P + 1)), *((f"s{i}{j}", whole(f"n * q{i} * q{j}")) for i, j in PAIRS)]


def factored() -> list[tuple[str, str]]:
    """Cholesky factor of the covariance c, and its determinant's square root."""
    out = []
    for i, j in PAIRS:
        rest = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
        out.append((f"l{i}{j}", f"sqrt(greatest(c{i}{j}{rest}, {number(1)}))" if i == j else f"(c{i}{j}{rest}) / l{j}{j}"))
    return [*out, ("det", " * ".join(f"l{i}{i}" for i in range(1, P + 1)))]


def estimate(factor: float, spec: McdSpec) -> list[tuple[str, str]]:
    """Centre, covariance (times factor, plus the floors' squares) and its Cholesky factor, from sums over h rows."""
    out = [(f"m{i}", f"cast(s{i} as double) / h") for i in range(1, P + 1)]
    out += [(f"c{i}{j}", f"{number(factor)} * (cast(s{i}{j} as double) / h - m{i} * m{j})" + (f" + {number((spec.floors[i - 1] * SCALE) ** 2)}" if i == j else "")) for i, j in PAIRS]
    return [*out, *factored()]


def shrunk() -> list[tuple[str, str]]:
    """Centre and covariance at the weight own, the rest being those (pm, pc) of the estimate one level up; and the Cholesky factor."""
    return [*((n, f"own * {n} + (1 - own) * p{n}") for n in PRIOR), *factored()]


def medians(spec: McdSpec, first: int) -> list[tuple[str, str]]:
    """A start from medians and quartile ranges, without correlation. p: five quantiles each; first: index of an array's first."""
    out = [(f"m{i}", f"cast(p{i}[{first + 2}] as double)") for i in range(1, P + 1)]
    for i, j in PAIRS:
        spread = f"(cast(p{i}[{first + 3}] as double) - cast(p{i}[{first + 1}] as double)) / {number(1.349)}"
        out.append((f"c{i}{j}", f"{spread} * {spread} + {number((spec.floors[i - 1] * SCALE) ** 2)}" if i == j else number(0)))
    return [*out, *factored()]


QUANTILES = (0.125, 0.25, 0.5, 0.75, 0.875)


def in_box(first: int) -> str:
    """Whether every component lies between its outer quantiles."""
    return " and ".join(f"q{i} >= p{i}[{first}] and q{i} <= p{i}[{first + 4}]" for i in range(1, P + 1))


def running(spec: McdSpec) -> list[tuple[str, str]]:
    """Of each bin: rows in nearer bins, the rows that the subset has, and the part of this bin that it takes in."""
    by = "partition by lang, source, start"
    return [
        ("n_before", f"coalesce(sum(n) over ({by} order by bin rows between unbounded preceding and 1 preceding), 0)"), ("h", f"{number(spec.part)} * sum(n) over ({by})"),
        ("share", f"case when n_before + n <= h then {number(1)} when n_before < h then (h - n_before) / n else {number(0)} end"),
    ]


def subset() -> list[tuple[str, str]]:
    """Sums over the nearest rows: whole bins exactly, and the one bin that is cut in proportion."""
    part = lambda c: f"coalesce(cast(sum(case when share = 1 then {c} end) as double), 0) + coalesce(max(case when share < 1 then share * cast({c} as double) end), 0)"
    return [("h", "max(h)"), *((c, part(c)) for c in MOMENTS)]


def chain(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    for name, sql in steps:
        df = df.withColumn(name, F.expr(sql))
    return df


def aggregated(df: DataFrame, by: list[str], steps: list[tuple[str, str]]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.expr(sql).alias(name) for name, sql in steps])


def edge() -> int:
    """The last bin within the 97.5 % point."""
    return math.floor(math.log(chi2_point(0.025, P) + 0.0001) * BINS)


def determinants(cells: DataFrame, spec: McdSpec, scratch: Scratch) -> DataFrame:
    """lang, source, n and the estimate (NAMES) of each stratum of cells (lang, source, q, n), not yet shrunk."""
    quantiles = scratch.write(aggregated(cells, KEYS, [("rows", "sum(n)"), *((f"p{i}", f"percentile(q{i}, array({', '.join(map(str, QUANTILES))}), n)") for i in range(1, P + 1))]), "quantiles")
    median = chain(quantiles, medians(spec, 0)).withColumn("start", F.lit("median"))
    boxed = cells.join(small_broadcast(quantiles), KEYS).where(in_box(0)).select(*cells.columns, F.lit("box").alias("start"))
    moments = aggregated(cells.withColumn("start", F.lit("mean")).unionByName(boxed), [*KEYS, "start"], sums()).withColumn("h", F.col("n").cast("double"))
    first = median.select(*KEYS, "start", *NAMES).unionByName(chain(moments, estimate(1.0, spec)).select(*KEYS, "start", *NAMES))
    state = scratch.write(first.withColumn("falls", F.lit(True)), "state0")
    for step in range(spec.steps):
        near = chain(cells.join(small_broadcast(state.select(*KEYS, "start", *NAMES)), KEYS), distance())
        bins = chain(aggregated(near, [*KEYS, "start", "bin"], sums()), running(spec))
        found = chain(aggregated(bins, [*KEYS, "start"], subset()), estimate(consistency(spec.part), spec)).select(*KEYS, "start", *[F.col(n).alias(f"_{n}") for n in NAMES])
        falls = F.lit(True) if step == 0 else F.col("_det") < F.col("det") * (1 - 1e-9)
        both = state.drop("falls").join(found, [*KEYS, "start"]).withColumn("falls", falls)
        state = scratch.write(both.select(*KEYS, "start", *[F.when(F.col("falls"), F.col(f"_{n}")).otherwise(F.col(n)).alias(n) for n in NAMES], "falls"), f"state{step + 1}")
        if state.where("falls").isEmpty():
            break
    least = scratch.write(state.groupBy(*KEYS).agg(F.min_by(F.struct(*NAMES), F.struct("det", "start")).alias("e")).select(*KEYS, "e.*"), "least")
    inside = aggregated(chain(cells.join(small_broadcast(least), KEYS), distance()).where(f"bin <= {edge()}"), KEYS, sums()).withColumn("h", F.col("n").cast("double"))
    final = chain(inside, estimate(consistency(0.975), spec)).select(*KEYS, *[F.col(n).alias(f"_{n}") for n in NAMES])
    kept = [F.when(F.col("_det").isNotNull(), F.col(f"_{n}")).otherwise(F.col(n)).alias(n) for n in NAMES]
    return scratch.write(least.join(final, KEYS, "left").join(quantiles.select(*KEYS, F.col("rows").alias("n")), KEYS).select(*KEYS, "n", *kept), "estimates")


def nested(found: DataFrame, spec: McdSpec, scratch: Scratch) -> DataFrame:
    """lang, source and the estimate of each language and source, shrunk towards its language's, which is shrunk towards that of all."""
    above = found.where(f"lang = '{ANY}'")
    for level in (1, 2):
        own = found.where(f"lang <> '{ANY}' and source {'=' if level == 1 else '<>'} '{ANY}'")
        up = above.select(F.col("lang").alias("_lang"), *[F.col(n).alias(f"p{n}") for n in PRIOR])
        both = own.withColumn("_lang", F.lit(ANY) if level == 1 else F.col("lang")).join(F.broadcast(up) if level == 1 else up, "_lang")
        above = scratch.write(chain(both.withColumn("own", F.col("n") / (F.col("n") + F.lit(spec.shrink))), shrunk()).select(*KEYS, *NAMES), f"shrunk{level}")
    return above


def robust_outliers(docs: DataFrame, spec: McdSpec = McdSpec(), text: str = "text") -> DataFrame:  # noqa: B008
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance2 (from the estimate of the row's
    language and source), row1, row2 (see row_keys) of each row.

    Rows are first counted per stratum and vector, so a hot source is aggregated before any shuffle, and all steps read these cells.
    A concentration step bins the cells by distance, with exact sums of components and products per bin, so a stratum's few hundred
    bins give the sums over exactly `part` of its rows (the last bin counts in proportion). Starts: medians and quartile ranges;
    mean and covariance of all rows; those of the rows within the outer quantiles of every component. The start with the least
    determinant is reweighted to the rows within its 97.5 % point. Rows beyond the cutoff are rejected.
    Only the small tables of bins and estimates are joined to the rows.

    Null and empty texts have no words, so they fail the base rule. Null language or source is a value of its own. Rows that
    fail the base rule don't shape the estimates. Repeated rows count as often as they occur. An empty table gives an empty
    result. Only doc_id, lang, source and the text column are read, whatever other columns there are.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    base = scratch.write(chain(statistics(docs, text), [("base_failed", BASE_FAILED)]), "base")
    rows = chain(base.where("not base_failed"), vector(spec))
    cells = scratch.write(rows.groupBy(*KEYS, *Q).agg(F.count(F.lit(1)).alias("n")), "cells")
    levels = [cells.select(*[F.col(k) if k in known else F.lit(ANY).alias(k) for k in KEYS], *Q, "n") for known in ((), ("lang",), KEYS)]
    cells = scratch.write(levels[0].unionByName(levels[1]).unionByName(levels[2]).groupBy(*KEYS, *Q).agg(F.sum("n").alias("n")), "levels")
    above = nested(determinants(cells, spec, scratch), spec, scratch)
    cutoff = chi2_point(spec.tail, P)
    scored = chain(chain(base, vector(spec)).join(small_broadcast(above), KEYS, "left"), distance())
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"), F.when(~F.col("base_failed"), F.col("d2")).alias("distance2"), "row1", "row2",
    )


def oracle(spec: McdSpec = McdSpec()) -> str:  # noqa: B008
    """The same result in DuckDB's SQL over a table documents."""

    def extended(source: str, steps: list[tuple[str, str]]) -> str:
        for name, sql in steps:
            source = f"(select *, {sql} as {name} from {source})"
        return source

    columns = lambda steps: ", ".join(f"{sql} as {name}" for name, sql in steps)
    key = lambda c: f"coalesce('=' || {c}, '')"
    names = ", ".join(NAMES)
    with_ = [
        f"""words as materialized (select doc_id, {key('lang')} as lang, {key('source')} as source, coalesce("text", '') as body, regexp_extract_all(coalesce("text", ''), '{WORD}') as w from documents)""",
        f"""lines as (select doc_id, lang, source, body, w, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls, case when len(w) >= {WINDOW} then list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' ')) else [] end as g from words)""",
        """windows as (select doc_id, unnest(g) as g, unnest(range(0, len(g))) as i from lines)""",
        """twice as (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows)""",
        f"""cover as (select doc_id, cast(sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) as bigint) as n_repeat_words from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from twice where n > 1) group by doc_id)""",
        f"""base as materialized (select l.doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(len(regexp_extract_all(body, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(ls) as bigint) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(w) < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * len(w) as base_failed from lines l left join cover c on l.doc_id = c.doc_id)""",
        f"""vectors as materialized (select lang, source, {', '.join(Q)} from {extended('(select * from base where not base_failed)', vector(spec))})""",
    ]
    with_.append(f"rows_ as materialized (select '{ANY}' as lang, '{ANY}' as source, {', '.join(Q)} from vectors union all select lang, '{ANY}', {', '.join(Q)} from vectors union all select lang, source, {', '.join(Q)} from vectors)")
    with_.append(f"cells as materialized (select lang, source, {', '.join(Q)}, count(*) as n from rows_ group by all)")
    quantiles = ", ".join(f"quantile_cont(q{i}, [{', '.join(map(str, QUANTILES))}]) as p{i}" for i in range(1, P + 1))
    with_.append(f"quantiles as materialized (select lang, source, count(*) as rows, {quantiles} from rows_ group by 1, 2)")
    boxed = f"(select c.*, 'box' as start from cells c join quantiles p on c.lang = p.lang and c.source = p.source where {in_box(1)})"
    moments = f"(select lang, source, start, cast(sum(n) as double) as h, {columns(sums())} from (select *, 'mean' as start from cells union all select * from {boxed}) group by 1, 2, 3)"
    with_.append(f"state0 as materialized (select lang, source, 'median' as start, {names} from {extended('quantiles', medians(spec, 1))} union all select lang, source, start, {names} from {extended(moments, estimate(1.0, spec))})")
    near = lambda t, more="": f"(select c.*{more}, {', '.join(f's.{n}' for n in NAMES)} from cells c join {t} s on c.lang = s.lang and c.source = s.source)"
    for step in range(spec.steps):
        bins = f"(select lang, source, start, bin, {columns(sums())} from {extended(near(f'state{step}', ', s.start'), distance())} group by 1, 2, 3, 4)"
        total = f"(select lang, source, start, {columns(subset())} from {extended(bins, running(spec))} group by 1, 2, 3)"
        falls = "true" if step == 0 else f"f.det < s.det * (1 - {number(1e-9)})"
        chosen = ", ".join(f"case when {falls} then f.{n} else s.{n} end as {n}" for n in NAMES)
        with_.append(f"state{step + 1} as materialized (select s.lang, s.source, s.start, {chosen} from state{step} s join {extended(total, estimate(consistency(spec.part), spec))} f on s.lang = f.lang and s.source = f.source and s.start = f.start)")
    with_.append(f"least as materialized (select lang, source, {names} from (select *, row_number() over (partition by lang, source order by det, start) as place from state{spec.steps}) where place = 1)")
    inside = f"(select lang, source, cast(sum(n) as double) as h, {columns(sums())} from (select * from {extended(near('least'), distance())} where bin <= {edge()}) group by 1, 2)"
    kept = ", ".join(f"case when f.det is not null then f.{n} else e.{n} end as {n}" for n in NAMES)
    with_.append(f"estimates as materialized (select e.lang, e.source, cast(q.rows as double) as n, {kept} from least e join quantiles q on e.lang = q.lang and e.source = q.source left join {extended(inside, estimate(consistency(0.975), spec))} f on e.lang = f.lang and e.source = f.source)")
    with_.append(f"shrunk0 as (select * from estimates where lang = '{ANY}')")
    for level, (own, up) in enumerate(((f"source = '{ANY}'", "true"), (f"source <> '{ANY}'", "e.lang = p.lang")), 1):
        both = f"(select e.*, e.n / (e.n + {number(spec.shrink)}) as own, {', '.join(f'p.{n} as p{n}' for n in PRIOR)} from (select * from estimates where lang <> '{ANY}' and {own}) e join shrunk{level - 1} p on {up})"
        for name, sql in shrunk():
            both = f"(select *{f' replace ({sql} as {name})' if name in NAMES else f', {sql} as {name}'} from {both})"
        with_.append(f"shrunk{level} as materialized (select lang, source, {names} from {both})")
    scored = f"(select b.*, {', '.join(f'e.{n}' for n in NAMES)} from {extended('base', vector(spec))} b left join shrunk2 e on b.lang = e.lang and b.source = e.source)"
    return (
        "with " + ",\n".join(with_) + f"\nselect doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(d2, 0) <= {number(chi2_point(spec.tail, P))} as kept"
        f" from {extended(scored, distance())}"
    )
