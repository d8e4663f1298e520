import hashlib
import io
import os
import random
import struct
import tarfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tests.conftest import SF
from unitloom.llm import media, mixing, packing, queries, tokens, warc, wordhash
from unitloom.llm.common import Scratch

RANKS = f"{queries.VOCABULARIES}/byte_bpe_50k.tiktoken"
needs_ranks = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary file")


# media ----------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * 64, b"y" * 65, bytes(range(256)) * 9])
def test_png_round_trip(payload):
    padded = media.pad(payload)
    assert len(padded) >= 64 and len(padded) % 64 == 0 and padded.rstrip(b"\0") == payload.rstrip(b"\0")
    stored = media.encode(padded)
    assert media.decode(stored) == padded and media.dimensions(stored[: media.HEADER]) == (64, len(padded) // 64, 8)
    with pytest.raises(ValueError):
        media.decode(stored[:50] + bytes([stored[50] ^ 1]) + stored[51:])


def read_png(data):
    """Samples of an 8-bit greyscale PNG, read by the format's rules alone (all five row filters), and its size."""
    assert data[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, parts, kinds = 8, [], []
    while at < len(data):
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        assert struct.unpack_from(">I", data, at + 8 + n)[0] == zlib.crc32(kind + body)
        kinds.append(kind)
        if kind == b"IHDR":
            width, height, depth, colour, *rest = struct.unpack(">IIBBBBB", body)
        if kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    assert kinds[0] == b"IHDR" and kinds[-1] == b"IEND" and (depth, colour, *rest) == (8, 0, 0, 0, 0)
    raw, out, above = zlib.decompress(b"".join(parts)), bytearray(), bytes(width)
    for r in range(height):
        rule, row, line = raw[r * (width + 1)], raw[r * (width + 1) + 1 : (r + 1) * (width + 1)], bytearray()
        for i, x in enumerate(row):
            left, up, corner = (line[i - 1] if i else 0), above[i], (above[i - 1] if i else 0)
            near = min((left, up, corner), key=lambda v: abs(left + up - corner - v))
            line.append((x + (0, left, up, (left + up) // 2, near)[rule]) % 256)
        out += line
        above = bytes(line)
    return bytes(out), (width, height, depth)


def brute_feature(payload):
    step, mean = len(payload) // 64, sum(payload) / len(payload)
    bits = [sum(payload[k * step : (k + 1) * step]) / step > mean for k in range(64)]
    return bytes(sum(bits[8 * k + j] << (7 - j) for j in range(8)) for k in range(8)).hex()


def test_media_table_against_the_stored_files(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    monkeypatch.setattr(Scratch, "drop", lambda self, *names: None)
    folders = []
    held = media.catalogue
    monkeypatch.setattr(media, "catalogue", lambda *a: folders.append(held(*a)) or folders[-1])
    got = media.media_table(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    store, root = media.open_store(folders[0][2])
    for r in got:
        with store.open_input_file(f"{root}/{r.shard}") as file:
            file.seek(r.offset)
            stored = file.read(r.length)
        payload, size = read_png(stored)
        own = texts[r.doc_id]
        assert payload == own.ljust(max(64, -(-len(own) // 64) * 64), b"\0") and size == (r.width, r.height, r.bits)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(own), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])) and r.digest == r.payload_sha256
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), brute_feature(payload))


def test_header_reads_fetch_the_header_alone(spark, tmp_path):
    png = media.encode(media.pad(b"some text"))
    (tmp_path / "x.tar").write_bytes(b"?" * 512 + png[: media.HEADER])  # nothing behind the header is there to read
    rows = spark.createDataFrame([(b"d", "x.tar", 512, len(png))], "digest binary, shard string, offset long, length long")
    assert [(r.width, r.height, r.bits) for r in media.header_columns(rows, f"file:{tmp_path}").collect()] == [(64, 1, 8)]


def test_a_folder_without_a_file_system_is_refused(spark):
    with pytest.raises(ValueError):
        media.open_store("/tmp/somewhere")
    assert Scratch(spark, "test").root.startswith("file:/")


def test_shards_are_plain_tar_files_and_headers_read_alone(spark, edges):
    scratch = Scratch(spark, "test-media")
    rows, members, folder = media.catalogue(edges, scratch)
    store, root = media.open_store(folder)
    names = set()
    for shard in {r.shard for r in members.collect()}:
        with tarfile.open(fileobj=io.BytesIO(store.open_input_file(f"{root}/{shard}").read())) as tar:
            for m in tar.getmembers():
                payload = media.decode(tar.extractfile(m).read())
                assert m.name == hashlib.sha256(payload).hexdigest() + ".png"
                names.add(m.name[:-4])
    assert names == {bytes(r.digest).hex() for r in rows.collect()}
    heads = media.header_columns(members, folder).collect()
    assert len(heads) == len(names) and all(h.width == 64 and h.bits == 8 for h in heads)
    assert rows.count() == 10


def test_small_shards_rotate(spark, edges):
    scratch = Scratch(spark, "test-rotate")
    rows = media.write_shards(edges, scratch.path("s"), shard_bytes=1).collect()
    assert len({r.shard for r in rows}) > 1 and len(rows) == 10


def test_media_edges(edges, empty):
    got = sorted(media.media_table(edges).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert got[0].payload_sha256 == got[1].payload_sha256 == hashlib.sha256(bytes(64)).hexdigest()
    assert got[4][2:] == got[7][2:] and got[4].doc_id != got[7].doc_id
    assert media.media_table(empty).count() == 0


# archives -------------------------------------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as sha", "1 as bytes")


def test_archives_read_back(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, None), (4, "u", ""), (5, "u", "é" * 50_000), (7, "u", "same"), (7, "u", "same")]
    got = sorted(warc.archived(pages(spark, rows)).collect(), key=lambda r: r.page_id)
    assert [(r.page_id, r.record_type, r.refers_to) for r in got] == [(1, "revisit", 7), (2, "revisit", 7), (3, "revisit", 4), (4, "response", None), (5, "response", None), (7, "response", None), (7, "response", None)]
    assert [r.payload_bytes for r in got] == [4, 4, 0, 0, 100_000, 4, 4]
    assert got[0].payload_digest == warc.sha1_base32(b"same") == got[6].payload_digest and got[1].target_uri == "http://b/%0D%0AX: y"
    assert warc.archived(pages(spark, [])).count() == 0


def test_no_payload_is_lost_between_rows_of_one_page_id(spark):
    rows = [(5, "u", "AAA"), (5, "u", "BBB"), (9, "u", "AAA"), (None, "u", "AAA"), (None, "u", "CCC"), (None, "u", "CCC"), (-3, "u", "BBB")]
    got = sorted(((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(pages(spark, rows)).collect()), key=str)
    digest = {x: warc.sha1_base32(x.encode()) for x in ("AAA", "BBB", "CCC")}
    want = [(5, "AAA", "revisit", 9), (5, "BBB", "response", None), (9, "AAA", "response", None), (None, "AAA", "revisit", 9), (None, "CCC", "response", None), (None, "CCC", "response", None), (-3, "BBB", "revisit", 5)]
    assert got == sorted(((p, digest[d], kind, r) for p, d, kind, r in want), key=str)


def test_small_payloads_are_responses(spark):
    rows = [(1, "a", "tiny"), (2, "b", "tiny"), (3, "c", "long enough"), (4, "d", "long enough")]
    got = {r.page_id: r.record_type for r in warc.archived(pages(spark, rows), warc.WarcSpec(least_bytes=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_dictionary_leads_the_file_and_serves_every_record(tmp_path):
    from pyarrow import fs

    rng = random.Random(5)
    records = [warc.record(i, f"http://h/{i}", (f"<p>{rng.random()} some common markup here</p>" * 20).encode(), 1, "D", None) for i in range(300)]
    places = warc.write_file(fs.LocalFileSystem(), str(tmp_path / "x.warc.zst"), records, warc.WarcSpec())
    data = (tmp_path / "x.warc.zst").read_bytes()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    unpack = warc.read_dictionary(io.BytesIO(data))
    assert [unpack.decompress(data[a : a + n]) for a, n in places] == records
    assert places[-1][0] + places[-1][1] == len(data)


def test_dictionary_learns_from_the_ends_of_long_records():
    rng = random.Random(6)
    phrases = [rng.randbytes(60) for _ in range(50)]
    records = [rng.randbytes(warc.PIECE) + b"".join(rng.sample(phrases, 50)) for _ in range(20)]
    words = warc.build_dictionary(records, warc.WarcSpec())
    assert sum(p in words for p in phrases) > 25


# packing --------------------------------------------------------------------------------------------------------------------


def brute_best_fit(sizes, allowed, spec):
    """Content and opened capacity of each bin, by plain search. Of bins with equal room the last one changed takes the item."""
    contents, opened, changed = [], [], []
    for i, size in enumerate(sizes):
        rooms = [(c - x, -at, b) for b, (x, c, at) in enumerate(zip(contents, opened, changed, strict=True)) if c - x >= size]
        if rooms:
            contents[min(rooms)[2]] += size
            changed[min(rooms)[2]] = i
            continue
        prices = []
        for c in allowed:
            if c >= size:
                content = size
                for later in sizes[i + 1 :]:
                    content += later if content + later <= c else 0
                prices.append((min(spec.cost(x) for x in spec.capacities if x >= content) / content, c))
        contents.append(size)
        changed.append(i)
        opened.append(min(prices)[1])
    return contents, opened


def brute_pack(sizes, spec):
    plans = [brute_best_fit(sizes, spec.capacities[k:], spec)[0] for k in range(len(spec.capacities))]
    return min(plans, key=lambda plan: sum(min(spec.cost(c) for c in spec.capacities if c >= x) for x in plan))


def test_best_fit_leaves_as_little_room_as_the_plain_version():
    spec = packing.PackSpec(capacities=(8, 16, 32))
    for seed in range(20):
        rng = random.Random(seed)
        sizes = sorted((rng.randrange(1, 33) for _ in range(200)), reverse=True)
        for k in range(3):
            bins, opened = packing.best_fit(sizes, spec.capacities[k:], spec)
            contents, capacities = brute_best_fit(sizes, spec.capacities[k:], spec)
            assert sorted(i for b in bins for i in b) == list(range(200))
            mine = [(c, c - sum(sizes[i] for i in b)) for b, c in zip(bins, opened, strict=True)]
            assert Counter(mine) == Counter((c, c - x) for x, c in zip(contents, capacities, strict=True)) and min(r for _, r in mine) >= 0


def test_a_bin_is_opened_by_what_it_will_hold():
    spec = packing.PackSpec(capacities=(8, 16))
    sizes = [5, 5, 5]  # two bins of 8 would hold 5 each; one of 16 holds all
    assert packing.opening(0, (8, 16), sizes, [-x for x in sizes], spec) == 16
    sizes = [5, 3]
    assert packing.opening(0, (8, 16), sizes, [-x for x in sizes], spec) == 8


def test_pack_takes_the_cheapest_plan_and_downsizes():
    spec = packing.PackSpec(capacities=(8, 16, 32), quadratic=64)
    bins, ends, cost = packing.pack([30, 9, 3, 2], spec)
    assert sum(map(spec.cost, ends)) == cost
    for b, end in zip(bins, ends, strict=True):
        content = sum([30, 9, 3, 2][i] for i in b)
        assert end == min(c for c in spec.capacities if c >= content)


def check_packing(rows, lengths, spec):
    at = {}
    for r in rows:
        at.setdefault(r.bin_id, []).append(r)
    assert sum(r.n_tokens for r in rows) == sum(lengths.values())
    for members in at.values():
        members.sort(key=lambda r: r.place)
        end = 0
        for r in members:
            assert r.place == end
            end += r.n_tokens
        assert {r.capacity for r in members} == {min(c for c in spec.capacities if c >= end)}
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
    for doc, parts in pieces.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and parts[-1][0] + parts[-1][1] == lengths[doc]


def encoded(texts):
    encode = tokens.encoder(tokens.read_ranks(RANKS)).encode_ordinary
    return {k: len(encode(t or "")) for k, t in texts.items()}


@needs_ranks
def test_tokens_are_those_of_the_public_vocabulary(spark, edges):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{queries.VOCABULARIES}/byte_bpe_50k.json")
    for r in tokens.with_tokens(edges, RANKS).collect():
        assert r.n_tokens == len(other.encode(r.text or "", add_special_tokens=False).ids) and r["dotted.name"] == "z"


@needs_ranks
def test_packing_query_against_brute_force(spark):
    rows = queries.op3_best_fit(spark, SF).collect()
    lengths = {k: n + 1 for k, n in encoded({r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}).items()}
    spec = packing.PackSpec()
    check_packing(rows, lengths, spec)
    most = spec.capacities[-1]
    sizes = sorted((min(most, n - at) for n in lengths.values() for at in range(0, n, most)), reverse=True)
    contents = defaultdict(int)
    for r in rows:
        contents[r.bin_id] += r.n_tokens
    assert Counter(contents.values()) == Counter(brute_pack(sizes, spec))


def test_packing_in_several_shards(spark):
    docs = spark.createDataFrame([(i, 1 + i * 37 % 900) for i in range(700)], "doc_id long, n long")
    spec = packing.PackSpec(capacities=(64, 256, 1024), shard_pieces=100)
    rows = packing.pack_documents(docs, spec, "n").collect()
    check_packing(rows, {i: 1 + i * 37 % 900 for i in range(700)}, spec)
    assert len({r.bin_id >> 32 for r in rows}) == 7
    waste = 1 - sum(r.n_tokens for r in rows) / sum({r.bin_id: r.capacity for r in rows}.values())
    assert waste < 0.1


@needs_ranks
def test_packing_edges(edges, empty, spark):
    spec = packing.PackSpec(RANKS)
    distinct = edges.where("doc_id <> 9")
    check_packing(packing.pack_documents(distinct, spec).collect(), {k: n + 1 for k, n in encoded({r.doc_id: r.text for r in distinct.collect()}).items()}, spec)
    assert packing.pack_documents(edges, spec).where("doc_id = 9").count() == 2
    assert packing.pack_documents(empty, spec).count() == 0
    odd = spark.createDataFrame([(None, 5), (1, None), (2, -4), (3, 0)], "doc_id long, n long")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in packing.pack_documents(odd, spec, "n").collect()) == [(0, 5), (1, 1), (2, 1), (3, 1)]


# mixing ---------------------------------------------------------------------------------------------------------------------


def word_class(word, topics):
    data = np.frombuffer(word, np.uint8)
    return int(wordhash.Words(data, np.array([0, len(data)]), lower=True).hashes()[0]) % topics


def brute_cells(rows, spec):
    """Tokens, topic and cell of each row (doc_id, text, lang, source)."""
    counts, usual, found = {}, defaultdict(lambda: np.zeros(spec.topics)), {}
    for i, text, lang, _ in rows:
        counts[i] = np.bincount([word_class(w, spec.topics) for w in (text or "").encode().split()], minlength=spec.topics)
        usual[lang] += counts[i]
    n = encoded({i: t for i, t, _, _ in rows})
    for i, _, lang, source in rows:
        total, share = counts[i].sum(), usual[lang] / max(usual[lang].sum(), 1)
        z = [(c - total * s) / max(total * s * (1 - s), 1e-9) ** 0.5 for c, s in zip(counts[i], share, strict=True)]
        found[i] = (n[i], (source or "(none)", lang or "(none)", f"t{z.index(max(z))}" if total else "(none)"))
    return found


def brute_fit(cells, spec, rounds=400):
    """Probabilities of cells {(source, lang, topic): tokens} by capped raking, each factor found by bisection."""
    total, budget = sum(cells.values()), spec.keep * sum(cells.values())
    goals = []
    for k, axis in enumerate(mixing.AXES):
        have = defaultdict(float)
        for c, t in cells.items():
            have[c[k]] += t
        have = {c: t for c, t in have.items() if t}
        given = {c: w for c, w in spec.targets.get(axis, {}).items() if c in have}
        if spec.targets.get(axis):
            others = sum(t for c, t in have.items() if c not in given)
            raw = {c: given.get(c, max(0, 1 - sum(given.values())) * t / others if others else 0) for c, t in have.items()}
        else:
            raw = {c: (t / total) ** spec.tempered.get(axis, 1) for c, t in have.items()}
        lo, hi = 0.0, 1e18
        for _ in range(300):
            mid = (lo + hi) / 2 if hi - lo < 1 else (max(lo, 1e-9) * hi) ** 0.5
            lo, hi = (lo, mid) if sum(min(have[c], mid * raw[c]) for c in have) >= budget else (mid, hi)
        goals.append({c: min(have[c], hi * raw[c]) for c in have})
    x = dict.fromkeys((c for c, t in cells.items() if t), 1.0)
    for _ in range(rounds):
        for k in range(3):
            for c, goal in goals[k].items():
                own = [cell for cell in x if cell[k] == c]
                lo, hi = 1e-12, 1e12
                for _ in range(100):
                    mid = (lo * hi) ** 0.5
                    lo, hi = (lo, mid) if sum(cells[i] * min(1, mid * x[i]) for i in own) >= goal else (mid, hi)
                for i in own:
                    x[i] *= hi
    return {c: min(1.0, v) for c, v in x.items()}, goals


def drawn(doc_id, seed):
    one = xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
    return xxhash.xxh64(struct.pack("<i", seed), seed=one).intdigest() % (1 << 52) / (1 << 52)


def check_mix(got, rows, spec, close=1e-4):
    known = brute_cells(rows, spec)
    cells = defaultdict(int)
    for n, cell in known.values():
        cells[cell] += n
    p, goals = brute_fit(cells, spec)
    expected = [defaultdict(float) for _ in range(3)]
    assert len(got) == len(rows)
    for r in got:
        n, cell = known[r.doc_id]
        assert (r.n_tokens, r.topic) == (n, cell[2])
        if cells[cell]:
            assert abs(r.probability - p[cell]) < close, (r, p[cell])
            assert r.selected == (drawn(r.doc_id, spec.seed) < r.probability)
        else:
            assert r.probability == 1 and r.selected
        for k in range(3):
            expected[k][cell[k]] += n * r.probability
    return expected, goals


@needs_ranks
def test_mixing_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op5_mixing(spark, SF).collect()
    expected, goals = check_mix(got, rows, mixing.MixSpec(RANKS), 1e-3)
    if got[0].marginal_miss < 1e-6:
        for have, goal in zip(expected, goals, strict=True):
            assert all(np.isclose(have[c], g, rtol=1e-4) for c, g in goal.items())


def sparse_rows():
    """Each source mostly of one language: many rounds until the marginals are met."""
    rng = random.Random(11)
    rows = []
    for s in range(25):
        main = rng.choice(("en", "fr", "de", "es"))
        for _ in range(12):
            lang = main if rng.random() < 0.8 else rng.choice(("en", "fr", "de", "es"))
            rows.append((len(rows), " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 200))), lang, f"s{s}"))
    return rows


@needs_ranks
@pytest.mark.parametrize("targets", [{}, {"lang": {"en": 0.3, "xx": 0.2}}, {"source": {"s0": 0.03, "s1": 0.01, "absent": 0.5}}])
def test_mixing_a_sparse_table(spark, targets):
    rows, spec = sparse_rows(), mixing.MixSpec(RANKS, targets=targets, keep=0.25, topics=2)
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5), spec).collect()
    expected, goals = check_mix(got, rows, spec)
    assert got[0].marginal_miss < 1e-6 and all(r.probability <= 1 for r in got)
    for have, goal in zip(expected, goals, strict=True):
        assert all(np.isclose(have[c], g, rtol=1e-4) for c, g in goal.items())


@needs_ranks
def test_marginals_that_cannot_be_met_are_reported(spark):
    rows = [(i, "one two three four", "en" if i < 50 else "fr", "a" if i < 50 else "b") for i in range(100)]
    spec = mixing.MixSpec(RANKS, targets={"lang": {"en": 0.9, "fr": 0.1}, "source": {"a": 0.1, "b": 0.9}}, keep=0.4, rounds=5)
    with pytest.warns(UserWarning, match="missed"):
        got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spec).collect()
    assert got[0].marginal_miss > 0.1 and all(0 <= r.probability <= 1 for r in got)


def test_the_axis_with_the_most_categories_is_distributed(spark):
    scratch = Scratch(spark, "test-wide")
    rows = [(f"s{s}", f"l{i}", f"t{t}", 10 + (7 * i + 5 * s + 3 * t) % 31, 1) for i in range(40) for s in range(3) for t in range(2) if (i + s + t) % 5]
    cells = scratch.write(spark.createDataFrame(rows, "_source string, _lang string, _topic string, tokens long, n long"), "cells")
    spec = mixing.MixSpec("", tempered={"source": 0.5, "lang": 0.9, "topic": 1.0}, keep=0.5)
    got = {r[:3]: r.p for r in (x for x in mixing.fitted(cells, spec, scratch).collect())}
    want, _ = brute_fit({r[:3]: r[3] for r in rows}, spec)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_factors_meet_their_goal():
    tokens_, x = np.array([10.0, 100.0, 1000.0]), np.array([3.0, 1.0, 0.1])
    for goal in (5.0, 60.0, 700.0, 1110.0):
        a = mixing.solve_factor(tokens_, x, goal)
        assert np.isclose((tokens_ * np.minimum(1, a * x)).sum(), goal)
    assert mixing.solve_factor(tokens_, x, 5000.0) * 0.1 >= 1 - 1e-9 and mixing.solve_factor(tokens_, x * 0, 5.0) == 0


@needs_ranks
def test_mixing_edges(edges, empty):
    spec = mixing.MixSpec(RANKS)
    got = sorted(mixing.mix_sources(edges, spec).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert all(r.selected and r.n_tokens == 0 for r in got[:2]) and got[0]["dotted.name"] == "z" and got[0].source == "a" and got[2].lang is None
    assert got[8].selected == got[9].selected
    assert mixing.mix_sources(empty, spec).count() == 0
