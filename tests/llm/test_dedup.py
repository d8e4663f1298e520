import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF
from unitloom.llm import common, minhash, relative_lz
from unitloom.llm.common import Scratch
from unitloom.llm.components import components
from unitloom.llm.minhash import MinHashSpec, agreement, minima, near_duplicates, pack, shingle_sets
from unitloom.llm.relative_lz import cut_spans, factors, merged, sliding_min
from unitloom.llm.wordhash import RunHash, Words, chunks, mix

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute_classes(rows, n, percent=80):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().translate(LOWER).split()
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, c in shared.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def brute_cut(rows, least=50):
    first, out = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for k in range(len(words) - least + 1):
            if first.setdefault(tuple(words[k : k + least]), i) < i:
                keep[k : k + least] = [False] * least
        out[i] = (len(words), keep.count(False), hashlib.sha256(b" ".join(w for w, y in zip(words, keep, strict=True) if y)).hexdigest())
    return out


def near_copies(seed=1, groups=6, copies=25):
    """Groups whose members drift apart, so that classes hang together by chains."""
    rng, rows, i = random.Random(seed), [], 0
    for g in range(groups):
        words = [f"w{g}_{rng.randrange(400)}" for _ in range(120)]
        for _ in range(copies):
            if rng.random() < 0.8:
                words = list(words)
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append((i, " ".join(words)))
            i += 1
    rng.shuffle(rows)
    return rows


def test_words_and_hashes_follow_split():
    texts = ["a b", "", "  x\ty\x0b z ", "é 漢字", None, "a b"]
    ((i, j, data, offsets),) = chunks(pa.array(texts))
    w = Words(data, offsets)
    assert (i, j) == (0, 6)
    assert w.counts.tolist() == [2, 0, 3, 2, 0, 2]
    assert [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)] == ["a", "b", "x", "y", "z", "é", "漢字", "a", "b"]
    h = w.hashes()
    assert h[0] == h[7] and h[1] == h[8] and len(set(h.tolist())) == 7
    runs = RunHash(h)
    assert runs.run(np.array([0]), 2) == runs.run(np.array([7]), 2) != runs.run(np.array([1]), 2)


def test_sliding_min():
    h = np.array([random.Random(k).randrange(100) for k in range(60)], np.uint64)
    for width in (1, 2, 7, 43):
        assert sliding_min(h, width).tolist() == [min(h[k : k + width]) for k in range(60 - width + 1)]


def test_merged_spans():
    assert merged([5, 0, 8], [9, 5, 12]) == [(0, 12)]
    assert merged([0, 7], [5, 9]) == [(0, 5), (7, 9)]


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_estimate_is_corrected_for_collisions(similarity):
    shared = round(2000 * similarity)
    values = mix(np.arange(4000, dtype=np.uint64))
    a, b = values[:2000], np.concatenate([values[:shared], values[2000 : 4000 - shared]])
    low = minima(np.concatenate([a, b]), np.array([0, 2000]), 1024)
    packed = pack(mix(low.astype(np.uint64), 5).astype(np.uint8) & np.uint8(15), 4)
    true = shared / (4000 - shared)
    assert abs(agreement(packed[:1], packed[1:], 1024, 4)[0] - true) < 0.07


def test_short_texts_have_one_shingle():
    values, at = shingle_sets(np.array([1, 2, 3], np.uint64), np.array([0, 0, 1, 3]), 5)
    assert np.diff(at).tolist() == [0, 1, 1]


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_match_brute_force(spark, n):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(10_000 + i, t) for i, t in near_copies()]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), MinHashSpec(shingle=n)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows, n)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_blocks_smaller_than_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "SPOKES", 4)
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rows = near_copies(seed=2, groups=2, copies=40)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), MinHashSpec(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows, 2)


def test_the_largest_component_of_a_bucket_is_not_copied(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = [(1, i, 0 if i < 40 else i, 0, 40, 3) for i in range(43)]
    met = minhash.meetings(spark.createDataFrame(rows, "bucket long, doc_id long, component long, top long, n_top long, n_rest long")).collect()
    assert sum(r.doc_id < 40 for r in met) == 40  # three strays fill one block, which meets each block of the others
    pairs = {(min(x.doc_id, y.doc_id), max(x.doc_id, y.doc_id)) for x in met for y in met if (x.lo, x.hi) == (y.lo, y.hi) and x.own == x.lo and y.own == x.hi and x.component != y.component}
    assert pairs == {(i, j) for j in (40, 41, 42) for i in range(j)}


def test_a_join_on_hot_keys_gives_what_a_plain_one_gives(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    scratch = Scratch(spark, "test-join")
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)] + [(None, -1)], "k long, v long")
    table = scratch.write(rows.where("k < 50").groupBy("k").count().withColumnRenamed("count", "n").withColumn("w", common.F.col("k") * 2), "table")
    for how in ("inner", "left"):
        got = sorted(map(str, common.join_counted(rows, table, ["k"], how).select("k", "v", "w").collect()))
        assert got == sorted(map(str, rows.join(table.drop("n"), "k", how).select("k", "v", "w").collect()))


def test_near_duplicates_edges(edges, empty):
    got = {r.doc_id: r for r in near_duplicates(edges, MinHashSpec(shingle=2)).collect()}
    assert sorted(got) == list(range(1, 10))
    assert [got[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert got[8].component_id == 5 and not got[8].kept and all(got[i].component_id == i for i in (1, 2, 3, 4, 5, 6, 7, 9))
    assert near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges, Scratch(spark, "test-chain"), "out").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


@pytest.mark.parametrize(("shard", "longest", "least"), [(4096, 1024, 50), (2, 16, 50), (1, 1024, 5)])
def test_cut_spans_match_brute_force(spark, monkeypatch, shard, longest, least):
    monkeypatch.setattr(relative_lz, "SHARD_BLOCKS", shard)
    monkeypatch.setattr(relative_lz, "LONGEST", longest)
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(3)
    base = [f"v{rng.randrange(50)}" for _ in range(400)]
    for k in range(60):  # passages of 45 to 120 words at shifting places, so that copies end inside blocks
        a, size = rng.randrange(280), rng.choice([45, 49, 50, 51, 60, 90, 120])
        rows.append((20_000 + k, " ".join([f"u{k}_{x}" for x in range(rng.randrange(30))] + base[a : a + size] + [f"t{k}"])))
    got = cut_spans(spark.createDataFrame(rows, "doc_id long, text string"), least=least).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_cut(rows, least)
    for r in got:
        assert r.n_removed == sum(s.hi - s.lo for s in r.cut_spans) and all(s.hi - s.lo >= least for s in r.cut_spans)


def longest_match(text, i, references):
    return max((next((k for k in range(len(text) - i) if j + k == len(r) or text[i + k] != r[j + k]), len(text) - i) for r in references for j in range(len(r))), default=0)


def test_the_parse_is_greedy_and_its_factors_are_the_longest():
    rng = random.Random(7)
    texts = [[f"w{rng.randrange(9)}" for _ in range(60)]]
    for _ in range(5):
        a = rng.randrange(40)
        texts.append(["x"] * rng.randrange(4) + texts[0][a : a + rng.randrange(8, 20)] + ["y"])
    (block, begin, end), _, _ = relative_lz.parse(np.zeros(6, int), np.arange(6), [" ".join(t).encode() + b" " for t in texts], 6)
    assert set(block) == {1, 2, 3, 4, 5}
    for b, i, j in zip(block, begin, end, strict=True):
        assert j - i >= 6 and any(texts[b][i:j] == r[k : k + j - i] for r in texts[:b] for k in range(len(r)))
    first = {b: (i, j) for b, i, j in reversed(list(zip(block, begin, end, strict=True)))}
    for b, (i, j) in first.items():
        assert j - i == longest_match(texts[b], i, texts[:1]) and all(longest_match(texts[b], k, texts[:b]) < 6 for k in range(i))


def test_words_are_compared_not_only_their_hashes(monkeypatch):
    monkeypatch.setattr(relative_lz.RunHash, "run", lambda self, start, length: np.zeros(len(start), np.uint64))
    texts = [b"a b c d ", b"e f g h ", b"x e f g ", b"e f g h i "]
    (block, begin, end), _, _ = relative_lz.parse(np.zeros(4, int), np.arange(4), texts, 3)
    assert list(zip(block, begin, end, strict=True)) == [(2, 1, 4), (3, 0, 4)]


def test_rows_of_one_doc_id_are_cut_each_by_its_own_spans(spark):
    passage, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "pq")
    rows = [(1, passage), (2, f"{passage} end"), (2, f"{other} {other}"), (None, passage)]
    got = sorted((r.doc_id or 0, r.text) for r in cut_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(1, passage), (2, "end"), (2, f"{other} {other}"), (0, passage)])


def test_cut_spans_edges(edges, empty):
    got = sorted(cut_spans(edges).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert got[0].text is None and got[0].n_words == 0 and got[0]["dotted.name"] == "z" and got[0].hash == "x"
    assert sum(r.n_removed for r in got) == 0  # repeats within one document or between rows of one id stay
    assert cut_spans(empty).count() == 0


def test_repeats_of_a_window_within_a_later_document_all_go(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    rows = [(1, passage), (2, f"{passage} middle {passage} end"), (3, f"start {passage}")]
    got = {r.doc_id: r.text for r in cut_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: passage, 2: "middle end", 3: "start"}


def test_factors_are_found_under_ties_of_anchors(spark):
    rows = [(1, "a " * 200), (2, "a " * 120 + "b")]
    got = factors(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "test")).collect()
    assert {r.doc_id for r in got} == {2}


@pytest.mark.parametrize("size", [40, 400, 5000])
def test_sketches_never_turn_a_link_away(size):
    from unitloom.llm.minhash import plausible

    spec = MinHashSpec()
    rng = random.Random(size)
    one = np.sort(mix(np.arange(size, dtype=np.uint64), 1))
    sketch = lambda x: (x >> np.uint64(32)).astype(np.uint32)[: spec.sketch]
    others, true = [], []
    for k in range(60):
        drop = rng.randrange(size // 3)
        other = np.sort(np.concatenate([np.array(rng.sample(one.tolist(), size - drop), np.uint64), mix(np.arange(rng.randrange(size // 6), dtype=np.uint64), 100 + k)]))
        shared = len(np.intersect1d(one, other))
        others.append(other)
        true.append(shared / (len(one) + len(other) - shared))
    got = plausible(sketch(one), len(one), [sketch(x) for x in others], np.array([len(x) for x in others]), spec)
    assert all(g for g, t in zip(got, true, strict=True) if t >= 0.8)
    assert not all(got) and (size > 512 or all(t > 0.7 for g, t in zip(got, true, strict=True) if g))
