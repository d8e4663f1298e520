"""Variable-capacity best-fit packing: several permitted sequence lengths, bins opened at the least cost, then downsized."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import with_tokens


@dataclass(frozen=True)
class PackSpec:
    """capacities: permitted sequence lengths, ascending. quadratic: the cost of a sequence of c tokens is c * (1 + c / quadratic).
    shard_pieces: pieces packed together in one task. vocabulary: path of the rank file that texts are measured with (not read
    where lengths are given)."""

    vocabulary: str = ""
    capacities: tuple[int, ...] = (512, 1024, 2048, 4096)
    quadratic: float = 65536.0
    shard_pieces: int = 50_000

    def cost(self, capacity: int) -> float:
        return capacity * (1 + capacity / self.quadratic)


def downsized(content: int, spec: PackSpec) -> int:
    """The least permitted capacity that holds the content."""
    return spec.capacities[bisect_left(spec.capacities, content)]


def expected_content(item: int, capacity: int, sizes: list[int], falling: list[int]) -> int:
    """Content that a bin of this capacity comes to if it is opened with `item` and takes the largest later item that fits, again
    and again. falling: sizes negated, so that they ascend."""
    content, at = sizes[item], item + 1
    while True:
        at = bisect_left(falling, content - capacity, at)
        if at == len(sizes):
            return content
        content += sizes[at]
        at += 1


def opening(item: int, allowed: tuple[int, ...], sizes: list[int], falling: list[int], spec: PackSpec) -> int:
    """The allowed capacity for a bin opened with `item`: that of the least cost for each token of its expected content, the bin
    being downsized to that content in the end. A small capacity that later items leave half empty so loses against a larger one."""

    def price(capacity: int) -> tuple[float, int]:
        content = expected_content(item, capacity, sizes, falling)
        return spec.cost(downsized(content, spec)) / content, capacity

    return min((c for c in allowed if c >= sizes[item]), key=price)


def best_fit(sizes: list[int], allowed: tuple[int, ...], spec: PackSpec) -> tuple[list[list[int]], list[int]]:
    """Bins (lists of item places) and the capacities they were opened with. sizes descend. An item goes to the open bin that it
    leaves the least room in."""
    bins: list[list[int]] = []
    opened: list[int] = []
    falling = [-s for s in sizes]
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has r tokens of room
    for item, size in enumerate(sizes):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(item)
        else:
            b, room = len(bins), opening(item, allowed, sizes, falling, spec)
            bins.append([item])
            opened.append(room)
        room -= size
        if room:
            held = by_room.setdefault(room, [])
            if not held:
                rooms |= 1 << room
            held.append(b)
    return bins, opened


def pack(sizes: list[int], spec: PackSpec) -> tuple[list[list[int]], list[int], float]:
    """Bins, their final capacities and their cost: the cheapest over the sets of capacities that bins may be opened with (all
    permitted ones, then without the smallest, and so on)."""
    best = None
    for k in range(len(spec.capacities)):
        bins, _ = best_fit(sizes, spec.capacities[k:], spec)
        ends = [downsized(sum(sizes[i] for i in b), spec) for b in bins]
        cost = sum(map(spec.cost, ends))
        if best is None or cost < best[2]:
            best = (bins, ends, cost)
    return best


def pack_documents(docs: DataFrame, spec: PackSpec, lengths: str | None = None) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, capacity, place of every piece of every row of docs.

    A document's length is its number of tokens under spec.vocabulary and one end mark, or the value of the column `lengths`. One
    longer than the largest capacity is cut into pieces of that length and a rest; start is a piece's first token,
    place its offset in its bin. Pieces are dealt by hash to shards of about shard_pieces, so a shard's memory is bounded and
    shards pack alone; best fit is within a shard. bin_id is unique over shards. Null and empty texts hold an end mark; a null or
    non-positive length counts as 1. Repeated rows are packed each; ties go by doc_id and piece, so equal tables give equal bins.
    An empty table gives an empty result. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    most = spec.capacities[-1]
    key = F.col("doc_id").cast("long").alias("doc_id")
    if lengths is None:
        measured = with_tokens(docs.select(key, F.col("text").cast("string").alias("text")), spec.vocabulary).select("doc_id", (F.col("n_tokens") + 1).alias("length"))
    else:
        measured = docs.select(key, F.greatest(F.coalesce(F.col(lengths).cast("long"), F.lit(1)), F.lit(1)).alias("length"))
    rows = scratch.write(measured, "lengths")
    total = rows.agg(F.sum(F.ceil(F.col("length") / most))).first()[0] or 0
    shards = max(1, -(-int(total) // spec.shard_pieces))
    pieces = rows.select("doc_id", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / most))).alias("piece")).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), F.least(F.lit(most), F.col("length") - F.col("piece") * most).cast("int").alias("size"), F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).alias("shard")
    )

    def run(table: pa.Table) -> pa.Table:
        ids, piece, size = (table.column(c) for c in ("doc_id", "piece", "size"))
        absent = ids.is_null().to_numpy()
        ids, piece, size = ids.fill_null(0).to_numpy(), piece.to_numpy(), size.to_numpy()
        order = np.lexsort((piece, ids, absent, -size.astype(np.int64)))
        sizes = size[order].tolist()
        bins, ends, _ = pack(sizes, spec)
        bin_id, capacity, place = (np.zeros(len(sizes), np.int64) for _ in range(3))
        base = table.column("shard")[0].as_py() << 32
        for b, (items, end) in enumerate(zip(bins, ends, strict=True)):
            at = 0
            for i in items:
                bin_id[i], capacity[i], place[i] = base + b, end, at
                at += sizes[i]
        ids, piece, size = pa.array(ids[order], mask=absent[order]), piece[order], size[order]
        return pa.table({"doc_id": ids, "piece": piece, "start": piece.astype(np.int64) * most, "n_tokens": size.astype(np.int64), "bin_id": bin_id, "capacity": capacity, "place": place})

    return pieces.groupBy("shard").applyInArrow(run, "doc_id long, piece int, start long, n_tokens long, bin_id long, capacity long, place long")
