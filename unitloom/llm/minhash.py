"""Near-duplicate documents by b-bit MinHash over word shingles, confirmed on full sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, join_counted, small_broadcast
from .components import components
from .wordhash import RunHash, Words, chunks, mix, signed


@dataclass(frozen=True)
class MinHashSpec:
    """shingle: words a shingle. percent: links have 100 * intersection >= percent * union. bands * rows minima make bands.
    minima: how many the estimate uses. bits: low bits kept of each. slack: an estimate may lie this far below the threshold and
    still be confirmed on full sets. sketch: the last round across components also compares the so many smallest hashes of each
    set, which are the whole sets of most texts.

    A link at similarity 0.8 can be lost in three ways: the pair shares no band (chance (1 - 0.8**5)**32 = 3e-6), its estimate
    lies more than slack low (5.6 standard errors: 1e-8), or its sketches, where they are not whole sets, turn it away (5 standard
    errors: 3e-7); less than 4e-6 in sum, and less for closer pairs."""

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    minima: int = 384
    bits: int = 4
    slack: float = 0.12
    sketch: int = 512


#: Members of a bucket that one task compares with one other block of members.
BLOCK = 1024
#: Pairs of one hub that one task confirms, with the hub's set sent once.
SPOKES = 512
#: Pairs of two components that one block of a bucket offers, in each round of linking across components; at last all of them.
OFFERS = (2, None)


def shingle_sets(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their offsets. A text of fewer than n words has one: its whole sequence."""
    counts = np.diff(first)
    runs = RunHash(words)
    sets = []
    for i, k in zip(first[:-1], counts, strict=True):
        if k >= n:
            sets.append(np.unique(runs.run(np.arange(i, i + k - n + 1), n)))
        else:
            sets.append(runs.run(np.array([i]), k) if k else np.empty(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def minima(values: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """k minima of each non-empty set (row) under hashes a * x + b mod 2**32."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    ab = mix(np.arange(2 * k, dtype=np.uint64), 99).astype(np.uint32)
    out = np.empty((len(at), k), np.uint32)
    for j in range(k):
        out[:, j] = np.minimum.reduceat(x * (ab[2 * j] | np.uint32(1)) + ab[2 * j + 1], at)
    return out


def pack(low: np.ndarray, bits: int) -> np.ndarray:
    """Rows of low-bit values as bytes, bit plane after bit plane."""
    planes = [np.packbits((low >> b) & 1, axis=1) for b in range(bits)]
    return np.concatenate(planes, axis=1)


def agreement(a: np.ndarray, b: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Collision-corrected similarity of packed signatures: equal low-bit values, counted by bit operations."""
    width = a.shape[-1] // bits
    differ = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1] + (width,), np.uint8)
    for p in range(bits):
        differ |= a[..., p * width : (p + 1) * width] ^ b[..., p * width : (p + 1) * width]
    equal = (k - np.bitwise_count(differ).sum(-1, dtype=np.int32)) / k
    chance = 2.0**-bits
    return (equal - chance) / (1 - chance)


def signatures(docs: DataFrame, spec: MinHashSpec, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, k1, k2 (a 128-bit key of the set; null if empty), sig (packed low bits), bands (hashes)."""
    banded = spec.bands * spec.rows

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in chunks(batch.column(1)):
                w = Words(data, offsets, lower=True)
                values, at = shingle_sets(w.hashes(), w.first, spec.shingle)
                sizes = np.diff(at)
                full = np.flatnonzero(sizes)
                none = pa.array(sizes == 0)
                keys = np.zeros((2, j - i), np.int64)
                sig = [None] * (j - i)
                bands = [None] * (j - i)
                if len(full):
                    starts = at[:-1][full]
                    for s in (0, 1):
                        keys[s, full] = signed(np.add.reduceat(mix(values, 31 + s), starts))
                    low = minima(values, starts, max(banded, spec.minima))
                    packed = pack(mix(low[:, : spec.minima].astype(np.uint64), 5).astype(np.uint8) & np.uint8((1 << spec.bits) - 1), spec.bits)
                    groups = low[:, :banded].reshape(len(full), spec.bands, spec.rows).astype(np.uint64)
                    h = np.broadcast_to(mix(np.arange(spec.bands, dtype=np.uint64), 6), groups.shape[:2]).copy()
                    for r in range(spec.rows):
                        h = mix(h ^ groups[:, :, r], 8 + r)
                    for row, d in enumerate(full):
                        sig[d] = packed[row].tobytes()
                        bands[d] = signed(h[row])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(sizes, pa.int64()), *(pa.array(keys[s], mask=np.asarray(none)) for s in (0, 1)), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "k1", "k2", "sig", "bands"],
                )

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, sig binary, bands array<long>")


def full_sets(docs: DataFrame, spec: MinHashSpec) -> DataFrame:
    """doc_id, shingles: the sorted distinct 8-byte shingle hashes as bytes."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                w = Words(data, offsets, lower=True)
                values, at = shingle_sets(w.hashes(), w.first, spec.shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([values[at[d] : at[d + 1]].tobytes() for d in range(j - i)], pa.binary())], names=["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def sketches(docs: DataFrame, spec: MinHashSpec) -> DataFrame:
    """doc_id, sketch: the smallest shingle hashes (their upper halves, sorted) as bytes."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                w = Words(data, offsets, lower=True)
                values, at = shingle_sets(w.hashes(), w.first, spec.shingle)
                upper = (values >> np.uint64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([upper[at[d] : min(at[d + 1], at[d] + spec.sketch)].tobytes() for d in range(j - i)], pa.binary())], names=["doc_id", "sketch"])

    return docs.mapInArrow(run, "doc_id long, sketch binary")


def plausible(one: np.ndarray, n_one: int, many: list[np.ndarray], n_many: np.ndarray, spec: MinHashSpec) -> np.ndarray:
    """Whether one sketch may be of a set similar enough to those of many. Sketches of whole sets give the similarity itself (two
    elements are allowed for equal upper halves); others give it over the hashes below the least bound, with 5 standard errors."""
    sizes = np.array([len(x) for x in many])
    flat, begin = np.concatenate(many), np.cumsum(sizes) - sizes
    top = np.uint32(0xFFFFFFFF)
    bound = np.minimum(one[-1] if n_one > spec.sketch else top, np.where(n_many > spec.sketch, flat[begin + sizes - 1], top))
    below = flat <= np.repeat(bound, sizes)
    place = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    shared = np.add.reduceat(below & (one[place] == flat), begin, dtype=np.int64)
    union = np.add.reduceat(below, begin, dtype=np.int64) + np.searchsorted(one, bound, "right") - shared
    whole = (n_many <= spec.sketch) & (n_one <= spec.sketch)
    slack = np.where(whole, 2 / np.maximum(union, 1), 5 * np.sqrt(0.16 / np.maximum(union, 1)))
    return shared >= (spec.percent / 100 - slack) * union


def spoked(pairs: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) as hub, spoke, part: the hub is the end with more pairs, and its pairs are dealt to parts of about SPOKES; and the
    ids in any pair."""
    degree = scratch.write(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), f"{name}_degree")
    side = lambda c: degree.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), "n")
    both = join_counted(scratch.write(join_counted(pairs, side("a"), ["a"]), f"{name}_half"), side("b"), ["b"])
    more = F.col("na") >= F.col("nb")
    hubs = both.select(F.when(more, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(more, F.col("b")).otherwise(F.col("a")).alias("spoke"), F.ceil(F.greatest("na", "nb") / SPOKES).cast("int").alias("parts"))
    return hubs.select("hub", "spoke", F.pmod(F.xxhash64("spoke", F.lit(3)), F.col("parts")).cast("int").alias("part")), degree.select("doc_id")


def confirmed(pairs: DataFrame, docs: DataFrame, spec: MinHashSpec, text: str, scratch: Scratch, name: str) -> DataFrame:
    """Those pairs (a, b) that hold on full sets. Texts that no pair needs are left behind before anything is shuffled; a hub's set
    travels once for each part of its pairs, not once a pair."""
    pairs = scratch.write(pairs, f"{name}_pairs")
    dealt, needed = spoked(pairs, scratch, name)
    dealt = scratch.write(dealt, f"{name}_dealt")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    sets = scratch.write(full_sets(rows.join(small_broadcast(needed), "doc_id", "left_semi"), spec), f"{name}_sets")
    percent = spec.percent

    def run(batches):
        hub, part, own = None, None, None
        for batch in batches:
            ends: tuple[list, list] = ([], [])
            for h, p, spoke, shingles in zip(*(batch.column(c) for c in range(3)), batch.column(3), strict=True):
                h, p, spoke, x = h.as_py(), p.as_py(), spoke.as_py(), np.frombuffer(shingles.as_buffer(), np.uint64)
                if spoke is None:  # the hub itself comes before its spokes
                    hub, part, own = h, p, x.copy()
                    continue
                if (h, p) != (hub, part):
                    raise ValueError("a pair came without its hub")
                small, large = (x, own) if len(x) < len(own) else (own, x)
                place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                shared = int((large[place] == small).sum())
                if 100 * shared >= percent * (len(x) + len(own) - shared):
                    ends[0].append(min(h, spoke))
                    ends[1].append(max(h, spoke))
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], names=["a", "b"])

    hubs = dealt.select("hub", "part").distinct().join(sets.withColumnRenamed("doc_id", "hub"), "hub").select("hub", "part", F.lit(None).cast("long").alias("spoke"), "shingles")
    spokes = dealt.join(sets.withColumnRenamed("doc_id", "spoke"), "spoke").select("hub", "part", "spoke", "shingles")
    grouped = hubs.unionByName(spokes).repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("spoke").asc_nulls_first())
    out = scratch.write(grouped.mapInArrow(run, "a long, b long"), f"{name}_links")
    scratch.drop(f"{name}_sets", f"{name}_degree", f"{name}_half", f"{name}_dealt")
    return out


def estimated(pairs: DataFrame, heads: DataFrame, spec: MinHashSpec, scratch: Scratch) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose collision-corrected estimate comes near it. One a may have very many b."""
    k, bits, least = spec.minima, spec.bits, spec.percent / 100 - spec.slack

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(agreement(x, y, k, bits) >= least))

    side = lambda c, s, n: heads.select(F.col("doc_id").alias(c), F.col("sig").alias(s), F.col("n_shingles").alias(n))
    pairs = scratch.write(pairs, "offered")
    hubs = scratch.write(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs")).join(side("a", "x", "n"), "a"), "hubs")
    both = join_counted(pairs, hubs, ["a"], n="pairs").join(side("b", "y", "m"), "b")
    return both.where(F.least("n", "m") * 100 >= F.greatest("n", "m") * spec.percent).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def meetings(members: DataFrame) -> DataFrame:
    """members (bucket, doc_id, component, ..., and of their bucket: top, its largest component; n_top, n_rest, rows in it and in the
    others) with lo, hi (the two blocks that meet) and own (which of them is the row's). Blocks of the largest component are numbered
    -1, -2, ... and meet the blocks of all others (0, 1, ...), which also meet each other. So the rows of the largest
    component are copied only where the others fill more than a block."""
    tops, rests = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_top", "n_rest"))
    top = F.col("component") == F.col("top")
    own = F.when(top, -1 - F.pmod(F.xxhash64("doc_id"), tops)).otherwise(F.pmod(F.xxhash64("doc_id"), rests)).cast("int")
    pair = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    with_rest = F.transform(F.sequence(F.lit(0), rests - 1), lambda k: F.when(top, pair(F.col("own"), k)).otherwise(pair(F.least("own", k), F.greatest("own", k))))
    with_top = F.when(top, F.array().cast("array<struct<lo:int,hi:int>>")).otherwise(F.transform(F.sequence(F.lit(0), tops - 1), lambda k: pair(-1 - k, F.col("own"))))
    return members.withColumn("own", own).withColumn("_meet", F.explode(F.concat(with_rest, with_top))).select(*members.columns, "own", "_meet.lo", "_meet.hi")


def across(members: DataFrame, spec: MinHashSpec, offers: int | None) -> DataFrame:
    """Pairs of one bucket that lie in two components so far and pass sizes and estimate; the `offers` likeliest of each two
    components in a block, or all that their sketches allow. members: see meetings(); with n_shingles, sig, sketch (null but in the
    last round). No task holds more than two blocks."""
    k, bits, least, percent = spec.minima, spec.bits, spec.percent / 100 - spec.slack, spec.percent
    dealt = meetings(members).select("bucket", "lo", "hi", "own", "doc_id", "component", "n_shingles", "sig", "sketch")

    def run(key, table):
        lo, hi = key[1].as_py(), key[2].as_py()
        own, ids, comp, n = (table.column(c).to_numpy() for c in ("own", "doc_id", "component", "n_shingles"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        held = [np.frombuffer(x, np.uint32) for x in table.column("sketch").to_pylist()] if offers is None else []
        found, likely = [np.empty((2, 0), np.int64)], [np.empty(0)]
        for i in left:
            fit = right[(comp[right] != comp[i]) & (np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * percent)]
            if lo == hi:
                fit = fit[fit > i]
            if len(fit):
                close = agreement(sig[i][None], sig[fit], k, bits)
                fit, close = fit[close >= least], close[close >= least]
                if offers is None and len(fit):
                    may = plausible(held[i], n[i], [held[x] for x in fit], n[fit], spec)
                    fit, close = fit[may], close[may]
                found.append(np.stack([np.full(len(fit), i), fit]))
                likely.append(close)
        pair, likely = np.concatenate(found, axis=1), np.concatenate(likely)
        if offers is not None and len(likely) > offers:
            c = np.sort(comp[pair], axis=0)
            order = np.lexsort((-likely, c[1], c[0]))
            c = c[:, order]
            new = np.ones(len(order), bool)
            new[1:] = (c[:, 1:] != c[:, :-1]).any(0)
            rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            pair = pair[:, order[rank < offers]]
        a, b = np.sort(ids[pair], axis=0)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("bucket", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, spec: MinHashSpec = MinHashSpec(), text: str = "text") -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text, ...).

    Equal sets fold into one head first. Bands give buckets of heads. Round one pairs each member with its bucket's smallest
    head only, so a bucket of m gives m - 1 pairs; the estimate sifts them and full sets confirm. Later rounds take buckets
    that still hold several components and compare across components, in blocks, without writing pairs out before the estimate:
    first the likeliest pairs of each two components, in the end all that remain, when few components are left to join.
    So every link that shares a band is found (but for the chances that MinHashSpec states), yet copies are never expanded into
    all pairs.

    Null, empty and wordless texts have n_shingles 0 and stand alone. Repeated doc_ids count as one document, of the smallest
    component that one of its rows is in; give rows ids of their own where that matters. An empty table
    gives an empty result. Only doc_id and the text column are read; other columns, whatever their names, don't matter.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    sigs = scratch.write(signatures(docs, spec, text), "sigs")
    classes = scratch.write(sigs.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")), "classes")
    heads = scratch.write(sigs.where("n_shingles > 0").join(classes.select(F.col("head").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "heads")
    bands = scratch.write(heads.select("doc_id", F.explode("bands").alias("bucket")), "bands")
    shared = scratch.write(bands.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    members = scratch.write(join_counted(bands, shared, ["bucket"]), "members")
    scratch.drop("bands", "shared")
    slim = heads.select("doc_id", "n_shingles", "sig")
    star = members.where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    links = confirmed(estimated(star, slim, spec, scratch), docs, spec, text, scratch, "star")
    tried = scratch.spark.read.parquet(scratch.path("star_pairs"))
    near = components(links, scratch, "near0")
    for k, offers in enumerate(OFFERS):
        labelled = members.join(near.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
        labelled = scratch.write(labelled, f"labelled{k}")
        kinds = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
        open_ = kinds.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        open_ = scratch.write(open_.select("bucket", F.col("top.component").alias("top"), F.col("top.n").alias("n_top"), (F.col("n") - F.col("top.n")).alias("n_rest"), "n"), f"open{k}")
        rest = join_counted(labelled, open_, ["bucket"]).join(slim, "doc_id").withColumn("sketch", F.lit(None).cast("binary"))
        if offers is None:
            rest = scratch.write(rest.drop("sketch"), "rest")
            there = scratch.write(rest.select("doc_id").distinct(), "rest_ids")
            rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
            held = sketches(rows.join(small_broadcast(there), "doc_id", "left_semi"), spec).dropDuplicates(["doc_id"])
            rest = rest.join(held, "doc_id")
        more = confirmed(across(rest, spec, offers).join(tried, ["a", "b"], "left_anti"), docs, spec, text, scratch, f"across{k}")
        tried = tried.unionByName(scratch.spark.read.parquet(scratch.path(f"across{k}_pairs")))
        links = links.unionByName(more)
        scratch.drop(f"labelled{k}", f"open{k}")
        if not more.isEmpty():
            near = components(links, scratch, f"near{k + 1}")
    found = classes.join(near.select(F.col("node").alias("head"), "component"), "head", "left").select("k1", "k2", "n", F.coalesce("component", "head").alias("component"))
    joined = join_counted(sigs.select("doc_id", "n_shingles", "k1", "k2"), scratch.write(found, "found"), ["k1", "k2"], "left")
    out = scratch.write(joined.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min(F.coalesce("component", "doc_id")).alias("component_id")), "out")
    scratch.drop(*(n for n in scratch.written if n != "out"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
