import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, same_rows
from unitloom.llm import chat, quality, queries, url_filter
from unitloom.llm.common import Scratch


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    same_rows(queries.queries()[name](spark, SF), duck, queries.oracle_sql()[name])


def test_chi_square_points():
    assert math.isclose(quality.chi2_point(0.05, 4), 9.4877, abs_tol=1e-3)
    assert math.isclose(quality.chi2_point(0.025, 6), 14.449, abs_tol=1e-3)
    assert quality.consistency(0.75) > 1.3


def ordinary(rng, n, first=0, lang="en", source="s", sign=""):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 3, 4, 5, 6, 7, 8]))) for _ in range(500)]
    return [(first + i, " ".join(rng.choice(words) + sign * (rng.random() < 0.1) for _ in range(rng.randrange(25, 200))), lang, source) for i in range(n)]


def test_outliers_match_their_sql_where_strata_are_large(spark):
    """Strata of hundreds of rows and of one, a source of lines and signs of its own, and names that would run together if joined."""
    import duckdb
    import pandas as pd

    rng = random.Random(9)
    rows = ordinary(rng, 300) + ordinary(rng, 200, 1000, "en", "t", "#") + ordinary(rng, 150, 2000, "fr", "s") + ordinary(rng, 60, 3000, "a:b", "c") + ordinary(rng, 60, 4000, "a", "b:c", "$$")
    rows += ordinary(rng, 40, 5000, None, "s") + ordinary(rng, 40, 6000, "", "s", "%") + ordinary(rng, 1, 7000, "xx", "y") + ordinary(rng, 3, 7100, "yy", None)
    rows += [(8000 + i, t.replace(" ", " ###"), *rest) for i, (_, t, *rest) in enumerate(ordinary(rng, 12))]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    same_rows(quality.robust_outliers(df).drop("distance2", "row1", "row2"), con, quality.oracle())
    got = {r.doc_id: r.kept for r in quality.robust_outliers(df).collect()}
    assert not any(got[8000 + i] for i in range(12)) and sum(got.values()) > 0.97 * (len(rows) - 12)


def mcd_by_search(x, h):
    """The least determinant of the covariance of h rows, over all subsets."""
    return min(np.linalg.det(np.cov(x[list(c)].T, bias=True)) for c in itertools.combinations(range(len(x)), h))


def test_the_determinant_is_near_the_minimum_over_all_subsets(spark):
    rng = np.random.default_rng(3)
    for trial in range(3):
        x = np.round(rng.normal(size=(14, 4)) * [900, 700, 800, 600] + 3000).astype(int)
        x[:3] += 9000  # three outliers together
        cells = spark.createDataFrame([("=en", "=s", *map(int, r), 1) for r in x], "lang string, source string, q1 long, q2 long, q3 long, q4 long, n long")
        scratch = Scratch(spark, f"test-mcd{trial}")
        spec = quality.McdSpec(part=11 / 14, floors=(0.0,) * 4, steps=20)
        quality.determinants(scratch.write(cells, "cells"), spec, scratch)
        least = spark.read.parquet(scratch.path("least")).first()
        found = (least.det**2) / quality.consistency(11 / 14) ** 4
        # the last bin counts in proportion, so the subset is not one of whole rows
        assert found < 1.5 * mcd_by_search(x, 11) and abs(least.m1 - x[3:, 0].mean()) < 900


def brute_repeats(text):
    words = (text or "").split()
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            covered |= set(range(i, i + 8))
    return len(covered)


def test_repeated_words(spark):
    texts = ["a b c d e f g h " * 2, "a " * 30, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(5, 16))), "", None, "one two"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.n_repeat_words for r in quality.statistics(df).collect()}
    assert got == {i: brute_repeats(t) for i, t in enumerate(texts)}


def test_quality_edges(edges, empty):
    got = {r.doc_id: r for r in quality.robust_outliers(edges).collect()}
    assert sorted(got) == list(range(1, 10))
    assert (got[1].n_words, got[1].kept, got[1].base_failed) == (0, False, True)
    assert got[6].n_repeat_words == 4000 and got[6].base_failed
    assert got[9].n_dup_lines == 1 and got[7].n_words == 1
    assert quality.robust_outliers(empty).count() == 0


def test_outliers_are_rejected_and_clean_rows_kept(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 3, 4, 5, 6, 7, 8]))) for _ in range(500)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(25, 400))), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(rng.choice(words) + "###" for _ in range(100)), "en", "s") for i in range(20)]
    got = {r.doc_id: r.kept for r in quality.robust_outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i] for i in range(20)) and all(got[i] for i in range(300))


def judged(spark, urls, rules):
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    return [(r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(rows, url_filter.rule_table(spark, rules)).orderBy("page_id").collect()]


def test_urls(spark):
    urls = ["http://WWW.Example.NET/en/x?q#f", "https://a.net", "https://a.net/", None, "no scheme", "http://example.com/de/", "http://notexample.com/de/", "https://x.org/fr/1", "https://x.org/fr", "http://net/" + "a/" * 300, "", "x://"]
    got = judged(spark, urls, url_filter.RULES)
    assert got[0] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("a.net", "", None, "allow") and got[2] == ("a.net", "/", "net/", "block")
    assert got[3] == got[4] == got[10] == got[11] == ("", "", None, "allow")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == (None, "allow")
    assert got[7][2:] == ("org/fr/", "allow") and got[8][2:] == (None, "allow") and got[9][2:] == ("net/", "block")


def test_rules_whose_path_ends_inside_a_segment_and_ties(spark):
    rules = [("block", "a.org/pre"), ("allow", "a.org/pre"), ("allow", "a.org/prefix/"), ("block", "bad rule")]
    assert [x[2:] for x in judged(spark, ["http://a.org/pretty", "http://a.org/prefix/1", "http://b.org/pre"], rules)] == [("a.org/pre", "block"), ("a.org/prefix/", "allow"), (None, "allow")]
    assert judged(spark, ["http://a.org/"], []) == [("a.org", "/", None, "allow")]


def linked(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("hash", F.lit("clash"))
    return {(r.conv_id, r.turn): r for r in chat.link_replies(df).collect()}


def test_quotations(spark):
    rows = [
        (1, 0, "a", "Hello there\nSecond line"), (1, 1, "b", "Different words"), (1, 2, "c", "On Monday a wrote:\n> hello   THERE\n\nMy answer"),
        (1, 3, "d", "c wrote:\n> My answer\n>> Hello there\n>> Second line\nYes"), (1, 4, "e", "> nothing known\nalone"), (2, 1, "a", "> Hello there\nother thread"),
        (1, 5, "f", None), (None, 0, "g", "> Hello there"), (1, 6, "h", ""), (1, 7, "i", "> Different words\n> Yes, of course\n> Yes"),
    ]
    got = linked(spark, rows)
    assert got[1, 2].reply_to == 0 and got[1, 2].text == "My answer" and got[1, 2].n_linked == 1  # a passage quoted in part, by its line
    assert (got[1, 3].reply_to, got[1, 3].quote_depth, got[1, 3].thread_root, got[1, 3].reply_depth, got[1, 3].text) == (2, 2, 0, 2, "Yes")
    assert got[1, 4].reply_to is None and got[1, 4].n_quoted == 1 and got[1, 4].n_linked == 0 and got[1, 4].text == "alone"
    assert got[2, 1].reply_to is None  # quotations link within a conversation only
    assert got[1, 5].text is None and got[1, 6].text == "" and got[None, 0].reply_to is None and got[None, 0].place is None
    assert got[1, 7].reply_to == 1  # most characters come from there
    assert [got[1, t].place for t in (0, 2, 3)] == [0, 1, 2]
    assert linked(spark, []) == {}


def test_a_passage_is_linked_whole_before_its_lines_are(spark):
    rows = [(1, 0, "a", "first line\nok"), (1, 1, "b", "ok"), (1, 2, "c", "> first line\n> ok\nfine"), (1, 3, "d", "> first\n> line ok\nwrapped anew"), (1, 4, "e", "> OK\nyes")]
    got = linked(spark, rows)
    assert (got[1, 2].reply_to, got[1, 2].n_quoted, got[1, 2].n_linked) == (0, 1, 1)
    assert got[1, 3].reply_to == 0 and got[1, 4].reply_to == 1


def test_passages(spark):
    text = "one\ntwo\n\nthree\nBob wrote:\n> a\n> > b\n> c\n>\n> d"
    got = spark.createDataFrame([(text,)], "t string").select(chat.passages(F.col("t")).alias("p")).first().p
    assert [(p.depth, p.lines) for p in got] == [(0, ["one", "two"]), (0, ["three"]), (1, ["a"]), (2, ["b"]), (1, ["c"]), (1, ["d"])]
    long = "x" * 5000 + " wrote:"
    assert spark.createDataFrame([(long + "\n> q\nown",)], "t string").select(chat.unquoted(F.col("t")).alias("p")).first().p == "own"


def test_conversations_in_reply_order(spark, monkeypatch):
    """Windows of few turns and parts of few messages give what large ones give."""
    rows = [(1, t, "r", f"message {t}" if t % 5 == 0 else f"> message {t - t % 5}\n\nmessage {t}") for t in range(0, 60)] + [(2, 7, "r", "hello"), (2, 9, "r", "> hello\nyes")]
    want = linked(spark, rows)
    monkeypatch.setattr(chat, "STRETCH", 4)
    monkeypatch.setattr(chat, "PART", 3)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.link_replies(df)
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert got == want and got[1, 13].reply_to == 10 and got[1, 13].place == 3
    threads = sorted(chat.conversations(out).collect(), key=lambda r: (r.conv_id, r.thread_root, r.part))
    assert len(threads) == 12 * 2 + 1 and [m.turn for m in threads[0].messages] == [0, 1, 2] and [m.turn for m in threads[1].messages] == [3, 4]
    for r in threads:
        assert all(m.reply_to is None or m.reply_to < m.turn for m in r.messages) and not any(">" in m.text for m in r.messages)


def test_a_chain_of_replies_reaches_its_root(spark):
    rows = [(1, 0, "a", "m0")] + [(1, t, "a", f"> m{t - 1}\nm{t}") for t in range(1, 40)]
    got = linked(spark, rows)
    assert all(got[1, t].thread_root == 0 and got[1, t].reply_depth == t == got[1, t].place for t in range(40))


def test_repeated_messages_share_links(spark):
    rows = [(1, 0, "a", "line"), (1, 1, "b", "> line\nx"), (1, 1, "b", "> line\nx")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.link_replies(df).collect()
    assert len(got) == 3 and [r.reply_to for r in got if r.turn == 1] == [0, 0]


def test_native_operators_run_no_python(spark):
    for df in (quality.statistics(spark.read.parquet(f"{SF}/documents.parquet")), quality.robust_outliers(spark.read.parquet(f"{SF}/documents.parquet")), chat.link_replies(spark.read.parquet(f"{SF}/conversations.parquet"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
