"""Mixing sources to target weights: token counts are raked to source, language and topic marginals by iterative proportional
fitting, then documents are drawn by calibrated probabilities.

The fit is one and the same at every size. A cell's probability is min(1, a * b * c) with one factor for each of its categories, so
probabilities never pass 1 and the marginals still hold. The axis with the most categories (as a rule the sources) stays distributed,
one row a category with its cells; a round solves its factors exactly, cell by cell, and brings back only the sums over the two
other axes, whose factors are then raked on the driver.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, join_counted, quoted, small, with_arrow_columns
from .tokens import lengths, read_ranks
from .wordhash import Words, chunks

AXES = ("source", "lang", "topic")
NONE = "(none)"
#: The two axes with fewer categories may come to at most so many pairs of categories, whose sums the driver holds.
NARROW_PAIRS = 200_000


@dataclass(frozen=True)
class MixSpec:
    """vocabulary: path of the rank file that counts tokens. targets: for an axis, category -> weight; categories left out share what
    they have in proportion, scaled to the rest, and categories without tokens don't count. tempered: for an axis, the power that
    turns its token shares into target shares (1 keeps them, 0 makes them equal). keep: share of all tokens to draw. A category's
    target is at most what it has; the others take up the rest. rounds, close: end of the fitting, by rounds or by largest relative
    miss of a marginal; it also ends when ten rounds have not lowered the miss by a hundredth. topics: word classes. seed: of the draw."""

    vocabulary: str
    targets: dict[str, dict[str, float]] = field(default_factory=dict)
    tempered: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.9, "topic": 0.9})
    keep: float = 0.7
    rounds: int = 100
    close: float = 1e-6
    topics: int = 6
    seed: int = 5


def counted(docs: DataFrame, spec: MixSpec, text: str) -> DataFrame:
    """docs with _tokens and _counts: the tokens of each whole text, and its words by class (a class: words, in lower case, whose
    hash leaves one remainder)."""
    bounded_batches(docs.sparkSession)
    ranks, topics = read_ranks(spec.vocabulary), spec.topics

    def make(batch, names):
        texts = batch.column(names.index(text))
        counts = []
        for i, j, data, offsets in chunks(texts):
            words = Words(data, offsets, lower=True)
            own = np.repeat(np.arange(j - i), words.counts) * topics + (words.hashes() % np.uint64(topics)).astype(np.int64)
            counts.append(np.bincount(own, minlength=(j - i) * topics))
        flat = np.concatenate([*counts, np.empty(0, np.int64)])
        return [lengths(texts, ranks), pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, topics), pa.int32()), pa.array(flat, pa.int64()))]

    return with_arrow_columns(docs, "_tokens long, _counts array<long>", make)


def with_topic(docs: DataFrame, spec: MixSpec, scratch: Scratch, text: str) -> DataFrame:
    """docs (written) with _tokens, _lang, _source and _topic. The tables name no topic, so a document's topic is the word class that
    its whole text has more of, against all words of its language, by the greatest number of standard deviations (the first
    class if several; '(none)' without words)."""
    rows = counted(docs, spec, text).select("*", *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(f"_{c}") for c in ("source", "lang")])
    rows = scratch.write(rows, "counted")
    sums = rows.groupBy("_lang").agg(*[F.sum(F.get("_counts", F.lit(k))).alias(f"_w{k}") for k in range(spec.topics)])
    usual = F.array(*[F.col(f"_w{k}") / F.greatest(sum((F.col(f"_w{j}") for j in range(spec.topics)), F.lit(0)), F.lit(1)) for k in range(spec.topics)])
    usual = scratch.write(sums.select("_lang", usual.alias("_usual")), "usual")
    n = F.aggregate("_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    excess = F.transform("_counts", lambda x, k: (x - F.col("_n") * F.get("_usual", k)) / F.sqrt(F.greatest(F.col("_n") * F.get("_usual", k) * (1 - F.get("_usual", k)), F.lit(1e-9))))
    top = F.array_position("_excess", F.array_max("_excess")) - 1
    langs = F.broadcast(usual) if small(usual) else usual
    return rows.withColumn("_n", n).join(langs, "_lang").withColumn("_excess", excess).withColumn("_topic", F.when(F.col("_n") == 0, NONE).otherwise(F.concat(F.lit("t"), top.cast("string")))).drop("_n", "_usual", "_excess", "_counts")


def raw_target(share, given: dict[str, float] | None, name, power: float, named: float, rest: float):
    """Target share, not yet scaled, of a category (numbers of the driver). named: the weights of the given categories that are there;
    rest: the token share of the others."""
    if not given:
        return share**power
    if name in given:
        return given[name]
    return max(0.0, 1 - named) * share / rest if rest else 0.0


def within_supply(raw: np.ndarray, supply: np.ndarray, budget: float) -> np.ndarray:
    """Goals in proportion to raw that come to the budget, none above its supply."""
    goal = np.zeros_like(supply)
    open_ = raw > 0
    while open_.any():
        left = budget - goal[~open_].sum()
        goal[open_] = raw[open_] * left / raw[open_].sum()
        over = open_ & (goal > supply)
        if not over.any():
            break
        goal[over] = supply[over]
        open_ &= ~over
    return goal


def solve_factor(tokens: np.ndarray, x: np.ndarray, goal: float) -> float:
    """The a with sum(tokens * min(1, a * x)) = goal; if there is none, the a that takes all that x allows."""
    there = (x > 0) & (tokens > 0)
    if goal <= 0 or not there.any():
        return 0.0
    tokens, x = tokens[there], x[there]
    order = np.argsort(-x, kind="stable")
    tokens, x = tokens[order], x[order]
    capped = np.cumsum(tokens) - tokens
    free = np.cumsum((tokens * x)[::-1])[::-1]
    a = (goal - capped) / free
    fits = np.flatnonzero(a * x <= 1)
    return float(a[fits[0]]) if len(fits) else float(1 / x.min())


def rake_pairs(capped: np.ndarray, free: np.ndarray, goals: tuple[np.ndarray, np.ndarray], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Factors for rows and columns that bring capped + free * factors to the goals; what is capped stays. Where the capped part alone
    is above its goal, the factor goes down by the whole excess, so that cells come off their caps."""
    over = [capped.sum(1 - axis) >= goals[axis] for axis in (0, 1)]
    whole = [np.maximum((capped + free).sum(1 - axis), 1e-300) for axis in (0, 1)]
    factors = tuple(np.where(o & (w > 1e-300), g / w, 1.0) for o, w, g in zip(over, whole, goals, strict=True))
    for _ in range(rounds):
        moved = 0.0
        for axis in (0, 1):
            have, want = (free * np.outer(*factors)).sum(1 - axis), goals[axis] - capped.sum(1 - axis)
            by = np.where(over[axis] | (have <= 0), 1.0, want / np.where(have > 0, have, 1.0))
            factors[axis][:] *= by
            moved = max(moved, float(np.abs(by - 1).max(initial=0)))
        if moved < 1e-9:
            break
    return factors


def narrow_goals(sums: dict[str, int], axis: str, spec: MixSpec, total: int, names: list[str]) -> np.ndarray:
    given, power = spec.targets.get(axis), spec.tempered.get(axis, 1.0)
    shares = {k: sums.get(k, 0) / total for k in names}
    named = sum(given[k] for k in names if k in given and shares[k]) if given else 0.0
    rest = sum(v for k, v in shares.items() if not given or k not in given)
    raw = np.array([raw_target(shares[k], given, k, power, named, rest) if shares[k] else 0.0 for k in names])
    return within_supply(raw, np.array([float(sums.get(k, 0)) for k in names]), spec.keep * total)


def wide_goals(sums: DataFrame, axis: str, spec: MixSpec, total: int, scratch: Scratch) -> DataFrame:
    """The same for the distributed axis: sums (key, supply) with goal."""
    given, power = spec.targets.get(axis), spec.tempered.get(axis, 1.0)
    share = F.col("supply") / F.lit(float(total))
    if given:
        known = F.element_at(F.create_map(*[F.lit(x) for k, v in given.items() for x in (k, float(v))]), F.col("key"))
        named, rest = sums.where("supply > 0").agg(F.sum(known), F.sum(F.when(known.isNull(), share))).first()
        raw = F.coalesce(known, share * F.lit(max(0.0, 1 - (named or 0.0)) / rest if rest else 0.0))
    else:
        raw = F.pow(share, F.lit(power))
    rows = scratch.write(sums.withColumn("raw", F.when(F.col("supply") > 0, raw).otherwise(0.0)), "raw_goals")
    scale, taken = 0.0, -1
    while True:  # categories that come to their supply leave the rest to the others, until no more do
        full = (F.col("raw") > 0) & (F.col("raw") * scale >= F.col("supply"))
        n, held, left = rows.agg(F.count_if(full), F.sum(F.when(full, F.col("supply")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("raw")))).first()
        if n == taken or not left:
            return rows.withColumn("goal", F.least(F.col("raw") * scale, F.col("supply").cast("double"))).drop("raw")
        scale, taken = max(scale, (spec.keep * total - held) / left), n


def fitted(cells: DataFrame, spec: MixSpec, scratch: Scratch) -> DataFrame:
    """cells (_source, _lang, _topic, tokens, n) with weight (share of the tokens expected to be drawn), p and miss (the largest
    relative miss of a marginal when the fit ended)."""
    keys = [f"_{a}" for a in AXES]
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("weight", F.lit(0.0)).withColumn("p", F.lit(1.0)).withColumn("miss", F.lit(0.0))
    kinds = cells.agg(*[F.count_distinct(k).alias(k) for k in keys]).first()
    wide = max(keys, key=lambda k: kinds[k])
    narrow = [k for k in keys if k != wide]
    if kinds[narrow[0]] * kinds[narrow[1]] > NARROW_PAIRS:
        raise ValueError(f"{narrow[0]} and {narrow[1]} have more than {NARROW_PAIRS} pairs of categories")
    sums = [{r[0]: r[1] for r in cells.groupBy(k).agg(F.sum("tokens")).collect()} for k in narrow]
    names = [sorted(s) for s in sums]
    goals = tuple(narrow_goals(s, k[1:], spec, total, n) for s, k, n in zip(sums, narrow, names, strict=True))
    shape = (len(names[0]), len(names[1]))
    place = [F.element_at(F.map_from_arrays(F.array(*map(F.lit, n)), F.array(*map(F.lit, range(len(n))))), F.col(k)) for n, k in zip(names, narrow, strict=True)]
    grouped = cells.where("tokens > 0").groupBy(F.col(wide).alias("key")).agg(F.sum("tokens").alias("supply"), F.sort_array(F.collect_list(F.struct((place[0] * shape[1] + place[1]).alias("at"), "tokens"))).alias("cells"))
    grouped = scratch.write(grouped, "grouped")
    aims = wide_goals(grouped.select("key", "supply"), wide[1:], spec, total, scratch).select("key", "goal")
    grouped = scratch.write(grouped.join(aims, "key"), "aimed")
    factors = [np.ones(shape[0]), np.ones(shape[1])]

    def each(batch, pair):
        """goal, places, tokens and probabilities of each row's cells."""
        for goal, own in zip(batch.column(batch.schema.get_field_index("goal")), batch.column(batch.schema.get_field_index("cells")), strict=True):
            at, tokens = (own.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            x, tokens = pair[at], tokens.astype(float)
            a = solve_factor(tokens, x, goal.as_py())
            yield at, tokens, np.minimum(1.0, a * x), a * x >= 1

    def totals(pair):
        def run(batches):
            sums = np.zeros((2, len(pair)))
            for batch in batches:
                for at, tokens, p, full in each(batch, pair):
                    sums[0, at[full]] += tokens[full]
                    sums[1, at[~full]] += (tokens * p)[~full]
            some = np.flatnonzero(sums.any(0))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[0, some]), pa.array(sums[1, some])], names=["at", "capped", "free"])

        return run

    misses: list[float] = []
    for k in range(spec.rounds):
        pair = np.outer(*factors).ravel()
        found = grouped.select("goal", "cells").mapInArrow(totals(pair), "at int, capped double, free double").groupBy("at").agg(F.sum("capped").alias("capped"), F.sum("free").alias("free"))
        both = np.zeros((2, *shape))
        for r in found.collect():
            both[(slice(None), *divmod(r.at, shape[1]))] = r.capped, r.free
        have = [both.sum(0).sum(1 - axis) for axis in (0, 1)]
        miss = max(float(np.max(np.abs(h / np.where(g > 0, g, 1) - 1), where=g > 0, initial=0)) for h, g in zip(have, goals, strict=True))
        misses.append(miss)
        if miss < spec.close or k == spec.rounds - 1 or (k >= 10 and min(misses[-10:]) > 0.99 * min(misses[:-10])):
            break
        for f, by in zip(factors, rake_pairs(both[0], both[1], goals), strict=True):
            f *= by
    if miss >= spec.close:
        warnings.warn(f"the marginals are missed by up to {miss:.2g} after {len(misses)} rounds; the column marginal_miss says so", stacklevel=2)

    def final(batches):
        for batch in batches:
            rows = [(at, p) for at, _, p, _ in each(batch, pair)]
            owner = np.repeat(np.arange(len(rows)), [len(at) for at, _ in rows])
            at, p = (np.concatenate([np.empty(0, t), *(r[k] for r in rows)]) for k, t in ((0, np.int32), (1, float)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(at, pa.int32()), pa.array(p)], names=["key", "at", "p"])

    probabilities = grouped.select("key", "goal", "cells").mapInArrow(final, "key string, at int, p double")
    at = F.col("at")
    named = [F.get(F.array(*map(F.lit, n)), i).alias(k) for n, k, i in zip(names, narrow, (F.floor(at / shape[1]).cast("int"), at % shape[1]), strict=True)]
    found = probabilities.select(F.col("key").alias(wide), *named, "p")
    joined = cells.join(found, keys, "left")
    expected = F.col("tokens") * F.coalesce("p", F.lit(0.0))
    drawn = spec.keep * total
    return scratch.write(joined.select(*cells.columns, (expected / drawn).alias("weight"), F.when(F.col("tokens") > 0, F.coalesce("p", F.lit(0.0))).otherwise(1.0).alias("p"), F.lit(miss).alias("miss")), "fitted")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, spec: MixSpec, text: str = "text") -> DataFrame:
    """docs with n_tokens, topic, weight (of its cell), probability, selected, marginal_miss added to each row.

    Tokens and word classes of the whole texts are counted once and written with the rows; they are summed per (source, language,
    topic), and the cells alone are fitted (see above). Marginals hold for the expected tokens, to spec.close; where no
    probabilities of at most 1 meet them all, marginal_miss gives the largest relative miss.
    A document is drawn by the hash of its id, so copies of a row go the same way and a second run draws the same documents.
    Null text has no tokens; documents without tokens weigh nothing and are kept. Null categories are '(none)'. Repeated rows
    count as often as they occur. An empty table gives an empty result. Other columns pass through; clashing names are replaced
    by the added columns.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    docs = docs.drop("n_tokens", "topic", "weight", "probability", "selected", "marginal_miss", *(c for c in docs.columns if c.startswith("_")))
    docs = docs.withColumn(text, F.col(text).cast("string"))
    rows = with_topic(docs, spec, scratch, text)
    keys = [f"_{a}" for a in AXES]
    cells = scratch.write(rows.groupBy(*keys).agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "cells")
    table = fitted(cells, spec, scratch).select(*keys, "n", "weight", "p", "miss")
    table = table.withColumnsRenamed({c: f"_{c}" for c in ("n", "weight", "p", "miss")})
    joined = rows.join(F.broadcast(table), keys) if small(table) else join_counted(rows, table, keys, n="_n")
    return joined.select(
        *quoted(*docs.columns), F.col("_tokens").alias("n_tokens"), F.col("_topic").alias("topic"), F.col("_weight").alias("weight"), F.col("_p").alias("probability"),
        (draw(F.col("doc_id"), spec.seed) < F.col("_p")).alias("selected"), F.col("_miss").alias("marginal_miss"),
    )
