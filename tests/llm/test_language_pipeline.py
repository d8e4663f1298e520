import itertools
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from unitloom.llm import language, mixing, packing, quality, queries
from unitloom.llm.queries import op7_language

MODEL = f"{queries.VOCABULARIES}/piece_bpe_32k.model"
SPEC = language.LanguageSpec(MODEL)
needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary files")


def every_segmentation(word, theta):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        parts.append(word[at:])
        total += np.prod([theta.get(p, language.UNKNOWN if len(p) == 1 else 0.0) for p in parts])
    return total


def test_forward_sums_over_all_segmentations():
    pieces = ["▁", "a", "b", "▁a", "ab", "ba", "bab", "▁ab"]
    theta = dict(zip(pieces, [0.1, 0.2, 0.15, 0.1, 0.2, 0.1, 0.05, 0.1], strict=True))
    lattice = language.Lattice(pieces)
    table = np.array([[*theta.values(), 0.0]]).T
    for word in ("▁a", "▁abab", "▁xba", "▁babbab", "▁babbabxabb"):
        got = language.forward(lattice, [word, word], table)
        assert np.allclose(np.exp(got[:, 0]), every_segmentation(word, theta))
        logs = np.log(np.maximum(table[:, 0], 1e-300))
        both = language.log_sums(lattice.ending([word]), logs)[-1], language.log_sums(lattice.ids([word])[:, ::-1], logs)[-1]
        assert np.allclose(both, got[0])


def test_words_of_any_length_keep_their_sum(monkeypatch):
    pieces = ["▁", "a", "b", "▁a", "ab", "ba", "bab", "▁ab"]
    lattice, table = language.Lattice(pieces), np.array([[0.1, 0.2, 0.15, 0.1, 0.2, 0.1, 0.05, 0.1, 0.0]] * 2).T * [1.0, 0.5]
    word = "▁" + "abbaab" * 300 + "x" * 90 + "ba" * 400
    logs, sums = np.log(np.maximum(table[:-1], 1e-300)), []
    for k in (0, 1):  # plain dynamic programming in logarithms, a character at a time
        theta, alpha = dict(zip(pieces, logs[:, k], strict=True)), [0.0]
        for j in range(1, len(word) + 1):
            parts = [alpha[j - n] + theta.get(word[j - n : j], np.log(language.UNKNOWN) if n == 1 else -np.inf) for n in range(1, min(j, 3) + 1)]
            alpha.append(np.logaddexp.reduce(parts))
        sums.append(alpha[-1])
    assert np.allclose(language.forward(lattice, [word], table)[0], sums)
    monkeypatch.setattr(language, "HELD", 20)
    assert np.allclose(language.forward(lattice, [word], table)[0], sums) and sums[0] < -2000


def test_learning_raises_the_likelihood():
    lattice = language.Lattice(["▁", "a", "b", "▁ab", "ab"])
    theta = language.learn(["ab ab ab ab b"], lattice, language.LanguageSpec("", rounds=6, smooth=1e-6))
    assert np.isclose(theta.sum(), 1) and theta[3] == max(theta)


def brute_identify(rows, train, pieces, spec):
    """(language, score) of each row by plain dynamic programming over single words."""
    known = {p: i for i, p in enumerate(pieces)}
    widest = max(map(len, pieces))

    def steps(word):
        """(from, to, piece) of all pieces in a word; -1 for an unknown character."""
        found = [(i, i + n, known.get(word[i : i + n], -1)) for i in range(len(word)) for n in range(1, min(widest, len(word) - i) + 1)]
        return [(i, j, k) for i, j, k in found if k >= 0 or j == i + 1]

    def sums(word, theta):
        alpha = [1.0] + [0.0] * len(word)
        for i, j, k in sorted(steps(word), key=lambda s: s[1]):
            alpha[j] += alpha[i] * (theta[k] if k >= 0 else language.UNKNOWN)
        return alpha

    models = {}
    for lang in sorted({x for i, _, x in rows if x is not None and i in train}):
        words = ["▁" + w for i, t, x in rows if x == lang and i in train and t for w in t.lower().split()]
        theta = np.full(len(pieces), 1 / len(pieces))
        for _ in range(spec.rounds):
            total = np.zeros(len(pieces))
            for word in words:
                alpha, beta = sums(word, theta), [0.0] * len(word) + [1.0]
                for i, j, k in sorted(steps(word), key=lambda s: -s[0]):
                    beta[i] += beta[j] * (theta[k] if k >= 0 else language.UNKNOWN)
                for i, j, k in steps(word):
                    if k >= 0:
                        total[k] += alpha[i] * beta[j] * theta[k] / alpha[-1]
            theta = (total + spec.smooth) / (total.sum() + spec.smooth * len(pieces))
        models[lang] = theta
    out = {}
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        logs = {x: sum(np.log(sums("▁" + w, theta)[-1]) for w in text.lower().split()) for x, theta in models.items()}
        best = max(sorted(logs), key=logs.get)
        out[i] = (best, 1 / sum(np.exp(v - logs[best]) for v in logs.values()))
    return out


@needs_model
def test_language_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 400").limit(60)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()] + [(-1, None, "en"), (-2, "12 34", "de"), (-3, "the", None), (-4, "la", None)]
    train = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, F.crc32(F.col("doc_id").cast("string")) % 5 != 0, SPEC).collect()}
    want = brute_identify(rows, train, language.vocabulary(MODEL), SPEC)
    assert got.keys() == want.keys() and len({p for p, _ in want.values()}) > 2
    assert all(got[i][0] == want[i][0] and np.isclose(got[i][1], want[i][1]) for i in want)


@needs_model
def test_too_many_languages_are_refused(spark):
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.identify(docs, F.lit(True), language.LanguageSpec(MODEL, most_languages=3))


@needs_model
def test_a_small_word_cache_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).coalesce(1)
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, F.lit(True), language.LanguageSpec(MODEL, rounds=1, cached_words=n)).collect()} for n in (0, 200_000))
    assert one == two


@needs_model
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    got = op7_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out and lang is not null").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert len(got) > 100 and right / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


@needs_model
def test_every_language_is_learned_however_long_its_texts(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 4000 if i % 4 else " ", lang) for i, lang in enumerate(["de", "en", "fr"] * 4)], "doc_id long, text string, lang string")
    spec = language.LanguageSpec(MODEL, sample_chars=1, rounds=1)
    langs, theta = language.piece_probabilities(docs, language.vocabulary(MODEL), spec)
    assert langs == ["de", "en", "fr"] and np.allclose(theta.sum(0), 1)


@needs_model
def test_language_edges(edges, empty, spark):
    got = sorted(language.identify(edges, F.lit(True), SPEC).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and got[0].score == 0 and got[3].lang_pred == "en" and got[6].lang_pred == "fr"
    digits = spark.createDataFrame([(1, "12 34", "en")], "doc_id long, text string, lang string")
    assert language.identify(digits, F.lit(True), SPEC).first().lang_pred == "und"
    assert {r.lang_pred for r in language.identify(edges, F.lit(False), SPEC).collect()} == {"und"}
    assert language.identify(empty, F.lit(True), SPEC).count() == 0


@needs_model
def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    other = docs.withColumn("lang", F.when(train, F.col("lang")).otherwise(F.lit("xx")))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(d, train, SPEC).collect()} for d in (docs, other))
    assert one == two


@needs_model
def test_pipeline_stages_against_brute_force(spark, duck):
    import corpus_pipeline as pipeline
    from tests.llm.test_dedup import brute_classes, brute_cut
    from tests.llm.test_storage_packing_mixing import RANKS, brute_cells, brute_fit, brute_pack, drawn, encoded

    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema, stages, scratch = docs.schema, dict(pipeline.STAGES), pipeline.Scratch(spark, "test-pipeline")

    clean = scratch.write(stages["quality_rules"](spark, docs, SF), "clean")
    verdicts = duck.execute(f"select doc_id, kept from ({quality.oracle()})").fetchall()
    assert clean.schema == schema and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, kept in verdicts if kept)

    rows = [(r.doc_id, r.text) for r in clean.collect()]
    single = scratch.write(stages["near_dedup"](spark, clean, SF), "single")
    assert single.schema == schema and sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in brute_classes(rows, 5).items() if i == c)

    rows = [(r.doc_id, r.text) for r in single.collect()]
    cut = scratch.write(stages["substring_dedup"](spark, single, SF), "cut")
    want = brute_cut(rows)
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.schema == schema and got.keys() == want.keys()
    for i, text in rows:
        assert len(got[i].text.split()) == want[i][0] - want[i][1] and got[i].n_chars == len(got[i].text) and (want[i][1] or got[i].text == text)

    mixed = scratch.write(stages["mixing"](spark, cut, SF), "mixed")
    rows, spec = [(r.doc_id, r.text, r.lang, r.source) for r in cut.collect()], mixing.MixSpec(RANKS, keep=0.7)
    known, cells = brute_cells(rows, spec), defaultdict(int)
    for n, cell in known.values():
        cells[cell] += n
    p, _ = brute_fit(cells, spec)
    sure = {i for i, (n, c) in known.items() if not cells[c] or abs(drawn(i, spec.seed) - p[c]) > 1e-3}
    taken = {r.doc_id for r in mixed.collect()}
    assert mixed.schema == schema and len(sure) > 0.95 * len(known) and taken & sure == {i for i in sure if not cells[known[i][1]] or drawn(i, spec.seed) < p[known[i][1]]}

    packed = stages["packing"](spark, mixed, SF).collect()
    lengths, most = {k: n + 1 for k, n in encoded({r.doc_id: r.text for r in mixed.collect()}).items()}, packing.PackSpec().capacities[-1]
    sizes = sorted((min(most, n - at) for n in lengths.values() for at in range(0, n, most)), reverse=True)
    contents = Counter()
    for r in packed:
        contents[r.bin_id] += r.n_tokens
    assert {r.doc_id for r in packed} == lengths.keys() and Counter(contents.values()) == Counter(brute_pack(sizes, packing.PackSpec()))


@needs_model
def test_stages_judge_rows_not_doc_ids(spark):
    import corpus_pipeline as pipeline

    good = [" ".join(f"{'abcdefghij'[(i * 7 + j * 3) % 10]}{i * 31 + j}word" for j in range(40)) for i in range(60)]
    rows = [(i, t, "en", "s") for i, t in enumerate(good)] + [(5, "too short", "en", "s"), (7, good[7], "en", "s"), (8, good[50], "en", "s"), (None, good[9], None, "s"), (None, "x " + " ".join(f"own{k}" for k in range(60)), "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clean = pipeline.quality_rules(spark, docs, SF)
    kept = Counter((r.doc_id, r.text) for r in clean.collect())
    assert kept[5, "too short"] == 0 and kept[5, good[5]] == 1 and kept[7, good[7]] == 2
    single = pipeline.near_dedup(spark, docs, SF)
    kept = Counter((r.doc_id, r.text) for r in single.collect())
    assert kept[7, good[7]] == 1 and kept[5, good[5]] == 1 and kept[5, "too short"] == 1  # one of equal rows, each of different ones
    assert kept[8, good[8]] == 1 and kept[8, good[50]] + kept[50, good[50]] == 1 and kept[None, good[9]] + kept[9, good[9]] == 1
    assert single.columns == docs.columns and sum(kept.values()) == 62


@needs_model
def test_pipeline_takes_an_empty_table(spark, edges):
    import corpus_pipeline as pipeline

    docs = edges.withColumn("n_chars", F.length("text").cast("long")).limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@needs_model
def test_pipeline_takes_edge_rows(spark, edges):
    import corpus_pipeline as pipeline

    docs = edges.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in pipeline.STAGES[1:-1]:
        out = pipeline.Scratch(spark, "test-edges").write(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and {1, 2, 3, 4, 5, 6, 7, 9} <= {r.doc_id for r in out.collect()} | ({4, 5, 6, 7, 9} if name == "mixing" else set())
        docs = out
    assert pipeline.packing(spark, docs, SF).count() >= docs.count()
