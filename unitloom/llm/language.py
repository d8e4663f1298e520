"""Language identification by segmentation-marginalised unigrams: per-language piece probabilities over a fixed public
vocabulary; a word's likelihood sums over all its segmentations by the forward algorithm."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, small_broadcast
from .wordhash import MASK, mix, powers

#: Mark of a word's start in the vocabulary.
START = "▁"
#: Forward sums of so many characters are scaled at once, each by its own logarithm, so that words of any length keep their sum.
STRETCH = 8
UNKNOWN = 1e-7
#: What a hash that is no piece stands for: the beginning of pieces, or nothing.
BEGINNING, NOTHING = -1, -2
#: Pieces' places of so many characters (words times length) are held at once.
HELD = 1 << 18
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@dataclass(frozen=True)
class LanguageSpec:
    """model: a sentencepiece file with the vocabulary. sample_chars: a language is learned from a sample of about so many
    characters of its rows (whole texts, drawn by hash, at least one). rounds: EM rounds. smooth: added to each piece's count.
    most_languages: more than these are refused, as the table of probabilities goes to every task (256 KB a language).
    cached_words: scores of so many words are kept by a task."""

    model: str
    sample_chars: int = 3_000_000
    rounds: int = 4
    smooth: float = 0.02
    most_languages: int = 256
    cached_words: int = 200_000


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file, lower-cased, distinct and in order; white space only as a start mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not special(i))
    return list(dict.fromkeys(p for p in pieces if START not in p[1:]))


class Lattice:
    """Piece places in many words at once. ids[n, i, l - 1] is the piece word n has at place i over l characters, -1 for none.

    Pieces are found by 64-bit hashes in an open table; hashes of substrings come from prefix sums. The table has the beginnings of all
    pieces too, so a place is looked up only as long as some piece goes on there.
    """

    SLOTS = 1 << 19

    def __init__(self, pieces: list[str]):
        self.widest = max(map(len, pieces), default=1)
        self.size = len(pieces)
        codes = {p[:n]: BEGINNING for p in pieces for n in range(1, len(p))} | {p: i for i, p in enumerate(pieces)}
        flat, at = self.flat(list(codes))
        keys, held = self.hashes(flat, at[:-1], np.diff(at)), np.fromiter(codes.values(), np.int32, len(codes))
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.held = np.full(self.SLOTS, NOTHING, np.int32)
        slot, owner, open_ = (keys >> np.uint64(45)).astype(np.int64), np.full(self.SLOTS, -1), np.arange(len(keys))
        while len(open_):  # all at once; of several that want a free slot one gets it, the others try the next
            wanting = open_[owner[slot[open_]] < 0]
            owner[slot[wanting]] = wanting
            open_ = open_[owner[slot[open_]] != open_]
            slot[open_] = (slot[open_] + 1) % self.SLOTS
        self.keys[slot], self.held[slot] = keys, held

    @staticmethod
    def flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        return chars, np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]).astype(np.int64)

    @staticmethod
    def prefix(chars: np.ndarray) -> np.ndarray:
        out = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(mix(chars, 3) * powers(INVERSE, len(chars) + 1)[:-1], out=out[1:])
        return out

    def hashes(self, chars: np.ndarray, start: np.ndarray, size) -> np.ndarray:
        sums = self.prefix(chars)
        return mix((sums[start + size] - sums[start]) * powers(BASE & MASK, len(chars) + 1)[start], 4)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash; BEGINNING if it only begins one, NOTHING if not even that."""
        slot = (h >> np.uint64(45)).astype(np.int64)
        out = np.full(len(h), NOTHING, np.int32)
        open_ = np.arange(len(h))
        while len(open_):
            held = self.held[slot[open_]]
            same = (held != NOTHING) & (self.keys[slot[open_]] == h[open_])
            out[open_[same]] = held[same]
            open_ = open_[(held != NOTHING) & ~same]
            slot[open_] = (slot[open_] + 1) % self.SLOTS
        return out

    def ids(self, words: list[str]) -> np.ndarray:
        """Of words that all have the same length."""
        length = len(words[0])
        chars, at = self.flat(words)
        sums, power = self.prefix(chars), powers(BASE & MASK, len(chars) + 1)
        width = min(self.widest, length)
        out = np.full((len(chars), width), -1, np.int32)
        room = length - np.arange(len(chars)) % length
        start = np.arange(len(chars))
        for size in range(1, width + 1):
            start = start[room[start] >= size]
            found = self.find(mix((sums[start + size] - sums[start]) * power[start], 4))
            out[start, size - 1] = np.maximum(found, -1)
            start = start[found != NOTHING]
        return out.reshape(len(words), length, width)

    def ending(self, words: list[str]) -> np.ndarray:
        """The same by the place where a piece ends: [n, j - 1, l - 1] for the piece of l characters before place j."""
        ids = self.ids(words)
        out = np.full_like(ids, -1)
        for l in range(1, ids.shape[2] + 1):  # noqa: E741
            out[:, l - 1 :, l - 1] = ids[:, : ids.shape[1] - l + 1, l - 1]
        return out


def by_length(words: list[str]):
    """Places of words of equal length, as many at a time as HELD allows."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, members in sorted(groups.items()):
        step = max(1, HELD // length)
        for k in range(0, len(members), step):
            yield np.array(members[k : k + step])


def forward(lattice: Lattice, words: list[str], theta: np.ndarray) -> np.ndarray:
    """Logarithms of the sums over all segmentations of each of some words of equal length, by language. theta has one more row, of
    zeros, for no piece. A character that no piece matches alone counts as unknown. The words are read in stretches, and only the
    sums at the last `widest` places are held, scaled by each word's and language's own factor."""
    length, widest = len(words[0]), min(lattice.widest, len(words[0]))
    ring = np.zeros((widest, len(words), theta.shape[1]))  # ring[j % widest]: sum at place j
    ring[0] = 1
    scale = np.zeros((len(words), theta.shape[1]))
    step = max(4 * widest, HELD // len(words))
    for p in range(0, length, step):
        lo = max(0, p - widest)
        ends = lattice.ending([w[lo : p + step] for w in words])
        for j in range(p + 1, min(p + step, length) + 1):
            piece = ends[:, j - 1 - lo]
            there = piece >= 0
            there[:, 0] = True
            word, back = np.nonzero(there)  # in order of words, each with one character back first
            piece = piece[word, back]
            part = theta[piece]
            part[piece < 0] = UNKNOWN
            part *= ring[(j - 1 - back) % widest, word]
            ring[j % widest] = np.add.reduceat(part, np.flatnonzero(back == 0), axis=0)
            if j % STRETCH == 0:
                top = np.maximum(ring.max(0), 1e-300)
                ring /= top
                scale += np.log(top)
    return np.log(ring[length % widest]) + scale


def log_sums(ids: np.ndarray, logs_of: np.ndarray) -> np.ndarray:
    """Logarithms of the sums at each place of words, of one language: places x words, where ids[:, j - 1] are the pieces that lead to
    place j from the places before it. logs_of: logarithms of the piece probabilities, the last one (no piece) -inf."""
    n, length, widest = ids.shape
    logs = np.full((widest + length, n), -np.inf)
    logs[widest - 1] = 0
    for j in range(length):
        part = logs_of[ids[:, j].T]
        part[0] = np.where(ids[:, j, 0] < 0, np.log(UNKNOWN), part[0])
        logs[widest + j] = np.logaddexp.reduce(logs[j : j + widest][::-1] + part, axis=0)
    return logs[widest - 1 :]


def learn(texts, lattice: Lattice, spec: LanguageSpec) -> np.ndarray:
    """Piece probabilities of one language by EM over its word counts."""
    counts: Counter[str] = Counter()
    for text in texts:
        counts.update((text or "").lower().split())
    words = sorted(START + w for w in counts)
    weight = np.array([counts[w[1:]] for w in words], float)
    theta = np.full(lattice.size, 1 / lattice.size)
    for _ in range(spec.rounds):
        total, logs_of = np.zeros(lattice.size), np.append(np.log(theta), -np.inf)
        for at in by_length(words):
            group = [words[i] for i in at]
            ids = lattice.ids(group)
            alpha, beta = log_sums(lattice.ending(group), logs_of), log_sums(ids[:, ::-1], logs_of)[::-1]
            length, widest = ids.shape[1:]
            after = np.concatenate([beta, np.full((widest, len(at)), -np.inf)])
            for i in range(length):
                piece = ids[:, i]
                some = piece >= 0
                share = np.exp(alpha[i][:, None] + after[i + 1 : i + 1 + widest].T - alpha[-1][:, None]) * weight[at][:, None]
                np.add.at(total, piece[some], share[some] * theta[piece[some]])
        theta = (total + spec.smooth) / (total.sum() + spec.smooth * lattice.size)
    return theta


def piece_probabilities(docs: DataFrame, pieces: list[str], spec: LanguageSpec, text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces x languages), learned from docs (lang, text, and doc_id for the draw).
    The result is bounded by the vocabulary times most_languages."""
    rows = docs.where(F.col("lang").isNotNull() & F.col(text).isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession, "language")
    place = F.xxhash64("doc_id", F.lit(17))
    place = F.struct(F.pmod(place, F.lit(1_000_000)).alias("part"), place.alias("whole"))
    least = F.min(F.when(F.col("text").rlike(r"\S"), place)).alias("least")  # drawn in any case, so that no language goes unlearned
    sizes = scratch.write(rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"), least), "sizes")
    if (n := sizes.count()) > spec.most_languages:
        raise ValueError(f"{n} languages are more than most_languages={spec.most_languages}")
    part = F.lit(float(spec.sample_chars)) / F.greatest(F.col("chars"), F.lit(1))
    drawn = rows.join(small_broadcast(sizes), "lang").where((place["part"] < part * 1_000_000) | F.coalesce(place == F.col("least"), F.lit(False))).select("lang", "text")

    def fit(table: pa.Table) -> pa.Table:
        theta = learn(table.column("text").to_pylist(), Lattice(pieces), spec)
        return pa.table({"lang": [table.column("lang")[0].as_py()], "theta": pa.array([theta.tolist()], pa.list_(pa.float64()))})

    found = sorted((r.lang, r.theta) for r in drawn.groupBy("lang").applyInArrow(fit, "lang string, theta array<double>").collect())
    scratch.drop()
    return [x for x, _ in found], np.array([t for _, t in found]).T if found else np.zeros((len(pieces), 0))


def identify(docs: DataFrame, train: Column, spec: LanguageSpec, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row of docs. train: a condition on docs' columns; rows that fulfil it and have text
    and lang are learned from. Predictions read nothing but the text.

    lang_pred is the language of the greatest likelihood (the first in order if equal), score its posterior probability under
    equal priors. Null texts, and texts without a letter, get `und` and score 0, as do all if nothing could be learned.
    Words are runs of non-white-space, in lower case and of any length; whole texts are scored, a task scoring each word once as long
    as its cache holds it. Repeated rows are predicted alike. An empty table gives an empty result; other columns don't matter.
    """
    bounded_batches(docs.sparkSession)
    pieces = vocabulary(spec.model)
    langs, theta = piece_probabilities(docs.where(train), pieces, spec, text)
    table = np.vstack([theta, np.zeros((1, len(langs)))])

    def run(batches):
        lattice = Lattice(pieces)
        places: dict[str, int] = {}
        scores = np.zeros((1024, len(langs)))
        for batch in batches:
            if len(places) > spec.cached_words:
                places = {}
            known = len(places)
            lists = []
            for t, readable in zip(batch.column(1), batch.column(2), strict=True):
                words = t.as_py().lower().split() if readable.as_py() and langs else []
                lists.append(np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words)))
            if len(places) > len(scores):
                scores = np.concatenate([scores, np.zeros((max(len(places) - len(scores), len(scores)), len(langs)))])
            fresh = [START + w for w in list(islice(reversed(places), len(places) - known))[::-1]]
            for at in by_length(fresh):
                scores[known + at] = forward(lattice, [fresh[i] for i in at], table)
            best, score = [], []
            for at in lists:
                if not len(at):
                    best.append("und")
                    score.append(0.0)
                    continue
                total = scores[at].sum(0)
                k = int(total.argmax())
                best.append(langs[k])
                score.append(float(1 / np.exp(total - total[k]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    readable = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id"), F.col(text).cast("string").alias("text"), readable.alias("readable")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
