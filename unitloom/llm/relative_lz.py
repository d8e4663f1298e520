"""Duplicate spans by relative Lempel-Ziv parsing against an index of reference blocks.

A text is cut into blocks: stretches of L-word windows with the same anchor, the smallest hash of k words in a window. Equal
windows have equal anchors wherever they stand, so whatever a block copies is in the index's blocks of the same anchor, and the
index can be dealt by anchor. Equal blocks are told by a 128-bit BLAKE2 digest of their words and folded into that of the smallest
document (their holder); the others are factors found whole. Each remaining block is factored greedily against every indexed block
of its anchor that a smaller document holds: the first window that the reference has (a hash index, words compared) opens
a factor, which extends word by word as far as the match goes; at the factor's end, the windows across the boundary are looked
up next. Factors are L words or longer by construction, and touching ones are joined per document.

An anchor with very many different blocks is split into shards by document. A shard's blocks are parsed against each other as
above; the windows that its parse leaves (each once a shard) meet those of the other shards by their digests, pre-aggregated.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, bounded_batches, join_counted, quoted
from .wordhash import RunHash, Words, chunks, mix, signed

#: Windows of a block at most, so that a text of one repeated word makes many blocks.
LONGEST = 1024
#: Different blocks of one anchor in a shard, about.
SHARD_BLOCKS = 4096
#: Bytes of blocks that are parsed at once (shards are not divided).
PARSE_BYTES = 1 << 20


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of h[i : i + width] for each i that has so many."""
    done = 1
    while 2 * done <= width:
        h = np.minimum(h[: len(h) - done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if width > done else h


def normalised(column) -> pa.Array:
    """Texts as their words joined by one space (nulls: empty), as bytes."""
    return pa.array([b" ".join(t.encode().split()) if t else b"" for t in column.to_pylist()], pa.large_binary())


def digest_of(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def blocks(words: np.ndarray, first: np.ndarray, least: int, k: int):
    """(text, first window, last window, anchor) arrays of the blocks of some texts; windows count within their text."""
    k = min(k, least)
    counts = np.diff(first)
    windows = np.maximum(counts - least + 1, 0)
    text = np.repeat(np.arange(len(counts)), windows)
    if not len(text):
        return text, text, text, text.astype(np.uint64)
    begin = np.cumsum(windows) - windows
    at = np.arange(len(text)) - np.repeat(begin - first[:-1], windows)
    anchor = sliding_min(RunHash(words).run(np.arange(len(words) - k + 1), k), least - k + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    i = np.flatnonzero(new)
    sizes = np.diff(np.append(i, len(at)))
    parts = -(-sizes // LONGEST)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    i = np.repeat(i, parts) + step * LONGEST
    j = np.append(i[1:], len(at)) - 1
    return text[i], at[i] - first[text[i]], at[j] - first[text[i]], anchor[i]


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, row (a hash of the text, which tells rows of one doc_id apart), text of the rows with text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    return rows.select("doc_id", F.xxhash64("text").alias("row"), "text")


def reference_blocks(rows: DataFrame, least: int, k: int) -> DataFrame:
    """doc_id, row, lo, hi (first and last window), anchor, d1, d2 (128-bit digest of all its words) of every block of every text."""

    def run(batches):
        for batch in batches:
            for i, _, data, offsets in chunks(normalised(batch.column(2))):
                w = Words(data, offsets)
                text, lo, hi, anchor = blocks(w.hashes(), w.first, least, k)
                body, at = data.tobytes(), w.first[text]
                places = zip(w.start[at + lo].tolist(), w.end[at + hi + least - 1].tolist(), strict=True)
                digest = np.frombuffer(b"".join(digest_of(body[a:b]) for a, b in places), np.int64).reshape(-1, 2)
                owner = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(signed(anchor)), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                    names=["doc_id", "row", "lo", "hi", "anchor", "d1", "d2"],
                )

    return rows.mapInArrow(run, "doc_id long, row long, lo int, hi int, anchor long, d1 long, d2 long")


def words_of(rows: DataFrame, least: int) -> DataFrame:
    """doc_id, row, lo, anchor, part, parts, words of the blocks listed in `spans` (lo, hi, anchor, parts) of each row (doc_id, row,
    text, spans). part is the shard of the anchor that the document is dealt to."""

    def run(batches):
        for batch in batches:
            source, columns = [], [[], [], [], []]
            for i, (text, spans) in enumerate(zip(normalised(batch.column(2)).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                words = text.split(b" ")
                for s in spans:
                    source.append(i)
                    for c, value in zip(columns, (s["lo"], s["anchor"], s["parts"], b" ".join(words[s["lo"] : s["hi"] + least])), strict=True):
                        c.append(value)
            owner = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True))],
                names=["doc_id", "row", "lo", "anchor", "parts", "words"],
            )

    made = rows.mapInArrow(run, "doc_id long, row long, lo int, anchor long, parts int, words binary")
    return made.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("parts")).cast("int"))


def shared_length(a: bytes, b: bytes) -> int:
    """Bytes that two byte strings begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax())


def parse(shard: np.ndarray, doc: np.ndarray, texts: list[bytes], least: int):
    """Greedy factors of blocks against the blocks of the same shard that smaller documents hold. shard, doc: arrays over the
    blocks; texts: their words, a space after each. Gives (block, first word, end) of the factors, (block, first word) of the
    windows that no smaller document of the shard has, and each word's byte end in its block (a list per block)."""
    column = pa.array(texts, pa.large_binary())
    w = Words(np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int64))
    counts = np.maximum(w.counts - least + 1, 0)
    block = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
    key = mix(RunHash(w.hashes()).run(at + w.first[block], least) ^ mix(shard[block].astype(np.uint64), 21))
    order = np.lexsort((at, block, doc[block], key))
    ranked, owner = key[order], doc[block[order]]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    leader = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    reference = np.full(len(block), -1)
    found = owner[leader] < owner
    reference[order[found]] = order[leader[found]]
    offsets, first = w.offsets.tolist(), w.first.tolist()
    begin, end = ((x - w.offsets[:-1].repeat(w.counts)).tolist() for x in (w.start, w.end))

    def match(b: int, i: int, c: int, j: int) -> int:
        """Where the words of block b from i on stop to equal those of block c from j on."""
        here = begin[first[b] + i]
        same = shared_length(texts[b][here:], texts[c][begin[first[c] + j] :])
        return bisect_right(end, here + same - 1, first[b] + i, first[b + 1]) - first[b]

    out: tuple[list, list, list] = ([], [], [])
    hit = np.flatnonzero(reference >= 0)
    here, done = -1, 0
    for b, i, r in zip(block[hit].tolist(), at[hit].tolist(), reference[hit].tolist(), strict=True):
        if b != here:
            here, done = b, 0
        if i + least <= done:
            continue  # inside the last factor; the windows across its boundary come next
        last = match(b, i, int(block[r]), int(at[r]))
        if last - i < least:  # equal hashes of different words: all other holders of the hash are tried
            others = np.flatnonzero((key == key[r]) & (doc[block] < doc[b]))
            last = max((match(b, i, int(block[o]), int(at[o])) for o in others), default=0)
        if last - i >= least:
            done = last
            for values, value in zip(out, (b, i, last), strict=True):
                values.append(value)
    left = reference < 0
    return out, (block[left], at[left]), [(begin[f:g], end[f:g]) for f, g in zip(first, first[1:], strict=False)]


def parsed(words: DataFrame, least: int) -> DataFrame:
    """doc_id, row, lo, hi, d1, d2 from blocks (see words_of) in order of anchor and part: factors (words lo to hi, no digest), and
    for anchors of several parts the windows that stay open, with their digest (no hi). A task holds one shard, or several that
    come to PARSE_BYTES."""

    def run(batches):
        def solve(rows: pa.Table):
            anchor, part = (rows.column(c).to_numpy() for c in ("anchor", "part"))
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
            texts = [t + b" " for t in rows.column("words").to_pylist()]
            doc, lo, parts = (rows.column(c).to_numpy() for c in ("doc_id", "lo", "parts"))
            (block, i, j), (open_block, open_at), places = parse(np.cumsum(new), doc, texts, least)
            split = parts[open_block] > 1
            open_block, open_at = open_block[split], open_at[split]
            digests = b"".join(digest_of(texts[b][places[b][0][k] : places[b][1][k + least - 1]]) for b, k in zip(open_block.tolist(), open_at.tolist(), strict=True))
            digests = np.frombuffer(digests, np.int64).reshape(-1, 2)
            block = np.array([*block, *open_block], np.int64)
            start, n = lo[block] + np.array([*i, *open_at], np.int32), len(i)
            closed = np.arange(len(block)) < n
            hi = np.where(closed, lo[block] + np.array([*j, *open_at], np.int32), 0)
            return pa.RecordBatch.from_arrays(
                [rows.column("doc_id").combine_chunks().take(pa.array(block)), rows.column("row").combine_chunks().take(pa.array(block)), pa.array(start, pa.int32()), pa.array(hi, pa.int32(), mask=~closed),
                 *(pa.array(np.concatenate([np.zeros(n, np.int64), digests[:, k]]), mask=closed) for k in (0, 1))], names=["doc_id", "row", "lo", "hi", "d1", "d2"])

        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= PARSE_BYTES:
                rows = pa.Table.from_batches(held)
                anchor, part = (rows.column(c).to_numpy() for c in ("anchor", "part"))
                cut = int(np.searchsorted((anchor == anchor[-1]) & (part == part[-1]), True)) if len(anchor) else 0
                if cut:
                    yield solve(rows.slice(0, cut))
                    held = rows.slice(cut).to_batches()
                    size = sum(b.nbytes for b in held)
        if held:
            yield solve(pa.Table.from_batches(held))

    return words.mapInArrow(run, "doc_id long, row long, lo int, hi int, d1 long, d2 long")


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Touching or overlapping [lo, hi) spans joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(lo, hi, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def factors(docs: DataFrame, scratch: Scratch, least: int = 50, k: int = 8, text: str = "text") -> DataFrame:
    """doc_id, row, lo, hi: factors (words lo to hi) of at least `least` words that also stand in a document of smaller doc_id.
    Their union is all words of all windows of that kind."""
    bounded_batches(docs.sparkSession)
    rows = keyed(docs, text)
    found = scratch.write(reference_blocks(rows, least, k), "blocks")
    index = scratch.write(found.groupBy("anchor", "d1", "d2").agg(F.min("doc_id").alias("holder"), F.count(F.lit(1)).alias("n")), "index")
    kinds = scratch.write(index.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").withColumn("parts", F.ceil(F.col("kinds") / SHARD_BLOCKS).cast("int")), "kinds")
    known = scratch.write(join_counted(index, kinds, ["anchor"], "left", n="kinds").where("n > 1 or parts is not null"), "known")
    scratch.drop("index", "kinds")
    hits = scratch.write(join_counted(found, known, ["anchor", "d1", "d2"]).where("doc_id > holder or (doc_id = holder and parts is not null)").select("doc_id", "row", "lo", "hi", (F.col("doc_id") > F.col("holder")).alias("whole"), "anchor", "parts"), "hits")
    scratch.drop("blocks", "known")
    open_ = hits.where("not whole").groupBy("doc_id", "row").agg(F.collect_set(F.struct("lo", "hi", "anchor", "parts")).alias("spans"))
    words = words_of(rows.join(open_, ["doc_id", "row"]), least)
    made = scratch.write(parsed(words.repartition("anchor", "part").sortWithinPartitions("anchor", "part"), least), "parsed")
    single = made.where("hi is null")
    first = single.groupBy("d1", "d2").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("holder < last").drop("last")
    across = join_counted(single, scratch.write(first, "windows"), ["d1", "d2"]).where("doc_id > holder").select("doc_id", "row", "lo", (F.col("lo") + least).alias("hi"))
    whole = hits.where("whole").select("doc_id", "row", "lo", (F.col("hi") + least).alias("hi"))
    out = scratch.write(whole.unionByName(made.where("hi is not null").select("doc_id", "row", "lo", "hi")).unionByName(across), "factors")
    scratch.drop("hits", "parsed", "windows")
    return out


def cut_spans(docs: DataFrame, least: int = 50, k: int = 8, text: str = "text") -> DataFrame:
    """docs with its text column cut and four columns added: n_words, n_removed (long), cut_spans (array of word spans [lo, hi)),
    kept_sha256. A text that loses words becomes its kept words joined by one space; another text stays as it is.

    A word goes if a window of `least` words that covers it also starts in a document of smaller doc_id. Null and empty texts,
    texts of fewer than `least` words and rows without a doc_id lose nothing (a null text stays null and has 0 words). Repeats
    within one document, or between rows of one doc_id, are not removed; rows of one doc_id with different texts are cut each by
    its own spans. An empty table gives an empty one. Other columns pass through untouched; names that clash with the added
    columns or `text` are replaced by them.
    """
    scratch = Scratch(docs.sparkSession, "rlz")
    spans = scratch.write(factors(docs, scratch, least, k, text).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_list(F.struct("lo", "hi")).alias("_spans")), "spans")
    scratch.drop("factors")
    rows = docs.withColumn(text, F.col(text).cast("string")).withColumn("_id", F.col("doc_id").cast("long")).withColumn("_row", F.xxhash64(text)).drop("n_words", "n_removed", "cut_spans", "kept_sha256", "_spans")
    joined = rows.join(spans, ["_id", "_row"], "left").drop("_id", "_row")
    names = [c for c in joined.columns if c != "_spans"]
    schema = T.StructType([*joined.select(*quoted(*names)).schema.fields, *T.StructType.fromDDL("n_words long, n_removed long, cut_spans array<struct<lo:int,hi:int>>, kept_sha256 string").fields])
    place = names.index(text)

    def run(batches):
        for batch in batches:
            out, n_words, n_removed, cuts, sha = [], [], [], [], []
            for body, span in zip(batch.column(place), batch.column(len(names)), strict=True):
                body = body.as_py()
                words = (body or "").encode().split()
                cut = []
                if span.is_valid:
                    lo, hi = (span.values.field(n).to_numpy(zero_copy_only=False).tolist() for n in (0, 1))
                    cut = merged(lo, hi)
                kept, at = [], 0
                for a, b in cut:
                    kept += words[at:a]
                    at = b
                line = b" ".join(kept + words[at:])
                out.append(line.decode() if cut else body)
                n_words.append(len(words))
                n_removed.append(sum(b - a for a, b in cut))
                cuts.append([{"lo": a, "hi": b} for a, b in cut])
                sha.append(hashlib.sha256(line).hexdigest())
            columns = [batch.column(c) for c in range(len(names))]
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(cuts, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), pa.array(sha, pa.string())],
                names=[*names, "n_words", "n_removed", "cut_spans", "kept_sha256"],
            )

    plain = [c.alias(f"c{k}") for k, c in enumerate(quoted(*names))]  # mapInArrow looks columns up by name and stumbles over dots
    return joined.select(*plain, F.col("_spans")).mapInArrow(run, schema)
