import pytest
from pyspark.sql import functions as F

from unitloom.functions import rules as R
from unitloom.operators import catalog, render, repair, translate, validate, verify
from unitloom.operators.terms import Term, introduced, term_matcher, unit_findings, with_matches
from unitloom.plans import pipeline, sinks
from unitloom.schemas import PAPER, TRANSLATION, UNIT
from unitloom.streaming import gate

TERMS = [
    Term("LCA", ("lowest common ancestor", "LCA"), ("наименьший общий предок",), "наименьший общий предок"),
    Term("read", ("read",), ("рид", "чтение"), "рид", gloss="фрагмент"),
    Term("long read", ("long read",), ("длинный рид",), "длинный рид", paren_en="never"),
]
LEXICON = R.Lexicon()


def unit(doc, k, text, kind="para", translate=True, **more):
    row = {"doc_id": doc, "ordinal": k, "unit_id": f"u{k + 1:03d}", "kind": kind, "level": None, "src_id": None, "translate": translate, "text": text, "spans": {}, "source_md": text, "fixed": None, "label": None, "graphics": None}
    return tuple((row | more)[n] for n in UNIT.names)


def frame(spark, units):
    return spark.createDataFrame(units, UNIT)


def done(spark, rows):
    return spark.createDataFrame([(d, u, s, t, None, None, None) for d, u, s, t in rows], TRANSLATION)


def test_longer_terms_take_their_stretch_and_order_is_of_occurrence():
    match = term_matcher(TERMS)
    assert match("The LONG reads and a read") == [("long read", 4), ("read", 21)]
    assert match("threads lowest *common* ancestors; LCA-s") == [("LCA", 8)]
    assert match("bread ready") == [] == match(None) == match("")


def verified(spark, units, results, body=("x", "x")):
    docs = sorted({u[0] for u in units})
    bodies = spark.createDataFrame([(d, *body) for d in docs], "doc_id string, body_source string, body_target string")
    found = verify.verify(frame(spark, units), done(spark, results), bodies, TERMS, LEXICON).collect()
    return sorted((r.unit_id, r.check, r.severity, r.message) for r in found)


def test_document_rules(spark):
    units = [unit("d", 0, "a read"), unit("d", 1, "the read"), unit("d", 2, "lowest common ancestor"), unit("d", 3, "LCA"), unit("d", 4, "read", kind="title")]
    results = [("d", "u001", "ok", "рид (read)"), ("d", "u002", "ok", "чтение (Read; x)"), ("d", "u003", "ok", "наименьший общий предок ( LCA )"), ("d", "u004", "ok", "предок (LCA)")]
    assert [m for *_, m in verified(spark, units, results)] == [
        "read: inconsistent forms ['рид', 'чтение']", "title: 1 in source, 0 translated", "missing gloss on first use: фрагмент", "(read) repeated after u001", "LCA expanded again (first at u003)"
    ]


def test_missing_terms_and_exceptions(spark):
    units = frame(spark, [unit("d", 0, "a read"), unit("d", 1, "LCA"), unit("d", 2, "a read")])
    pairs = verify.translated_pairs(units, done(spark, [("d", "u001", "ok", "слово"), ("d", "u002", "ok", "метод LCA"), ("d", "u003", "ok", "слово")]), spark.createDataFrame([("d", "u003", ["read"])], "doc_id string, unit_id string, terms array<string>"))
    got = verify.unit_issues(with_matches(pairs, TERMS), TERMS, LEXICON).collect()
    assert [(r.unit_id, r.message) for r in got] == [("u001", "term missing: read → рид")]


def test_whole_verification_keeps_no_text_and_finds_what_the_rules_find(spark):
    units = frame(spark, [unit("d", 0, "read of 5 not"), unit("d", 1, "the LCA read"), unit("d", 2, "gone", kind="figure", graphics=["g.png"]), unit("d", 3, "read may")])
    results = done(spark, [("d", "u001", "ok", "6"), ("d", "u002", "ok", "(LCA) рид (read)"), ("d", "u003", "needs_repair", "?"), ("d", "u004", "ok", "рид (read) чтение")])
    bodies = spark.createDataFrame([("d", "[1] ![](assets/g.png)", "[2]")], "doc_id string, body_source string, body_target string")
    pairs = verify.translated_pairs(units, results)
    kept = unit_findings(pairs, TERMS, R.unit_rules(F.col("text"), F.col("target"))).columns
    assert not {"text", "target", "plain", "plain_target"} & set(kept)
    matched = with_matches(pairs, TERMS)
    parts = verify.union_all(verify.status_issues(results), verify.unit_issues(matched, TERMS, LEXICON), verify.document_issues(matched, TERMS), verify.body_issues(bodies), verify.figure_issues(units, bodies))
    got = sorted(map(tuple, verify.verify(units, results, bodies, TERMS).collect()))
    assert got == sorted(map(tuple, parts.collect())) and {"numbers", "negation", "glossary", "first_mention", "structure", "citations", "figures", "status", "hedging"} <= {r[2] for r in got}


def test_gate(spark):
    issues = spark.createDataFrame([("a", "-", "x", "FAIL", "m"), ("a", "-", "x", "WARN", "m"), ("b", "-", "x", "WARN", "m")], "doc_id string, unit_id string, check string, severity string, message string")
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_id string")
    got = verify.gate(docs, issues)
    assert {r.doc_id: (r.n_fail, r.n_warn, r.exit_code) for r in got.collect()} == {"a": (1, 1, 1), "b": (0, 1, 2), "c": (0, 0, 0)}
    assert {r.doc_id for r in verify.publishable(got).collect()} == {"b", "c"} and verify.publishable(got, force=True).count() == 3


def test_figures(spark):
    units = frame(spark, [unit("d", 0, "c", kind="figure", graphics=["f1.jpg", "f2.jpg"])])
    bodies = spark.createDataFrame([("d", "![a](assets/f1.jpg)![b](assets/f2.jpg)", "![a](assets/f1.jpg)")], "doc_id string, body_source string, body_target string")
    files = spark.createDataFrame([("d", "f2.jpg")], "doc_id string, name string")
    got = sorted(r.message for r in verify.figure_issues(units, bodies, files).collect())
    assert got == ["missing file assets/f1.jpg", "missing image assets/f2.jpg in RU"]


def test_prompt(spark):
    units = frame(spark, [unit("d", 0, "One. Two here. LCA is long read? A read!", translate=True), unit("d", 1, "skip", kind="heading"), unit("d", 2, "The read of LCA")])
    got = {r.unit_id: r.prompt for r in translate.prompts(units, TERMS).collect()}
    assert got["u001"].startswith("Glossary:\nLCA → наименьший общий предок\nlong read → длинный рид\nread → рид (read; фрагмент)\n\nAbbreviation notes: first use: LCA\n\nFirst-mention notes: first use: read\n\nText:\n")
    assert got["u003"] == "Glossary:\nread → рид\nLCA → наименьший общий предок\n\nAbbreviation notes: already introduced: LCA\n\nFirst-mention notes: already introduced: read\n\nContext (do not translate): LCA is long read? A read!\n\nText:\nThe read of LCA"
    assert got["u002"].startswith("Context")


def test_translate_retries(spark):
    rows = spark.createDataFrame([("d", "u1", "a ⟦N1⟧", "p"), ("d", "u2", "b", "fail"), ("d", "u3", "c ⟦N1⟧", "never")], "doc_id string, unit_id string, text string, prompt string")

    def translator(talk):
        if talk[1]["content"] == "fail":
            raise RuntimeError("down")
        return "ok ⟦N1⟧" if len(talk) > 2 and talk[1]["content"] == "p" else "no mark"

    got = {r.unit_id: (r.status, r.text, r.error) for r in translate.translate(rows, translator, "s").collect()}
    assert got == {"u1": ("ok", "ok ⟦N1⟧", None), "u2": ("needs_repair", "", "down"), "u3": ("needs_repair", "no mark", "missing placeholders: ⟦N1⟧")}


def test_translations_are_kept(spark, tmp_path):
    rows = spark.createDataFrame([("d", f"u{k}", f"text {k} ⟦N1⟧", f"p{k}") for k in range(7)], "doc_id string, unit_id string, text string, prompt string")

    def answering(name, failing):
        def translator(talk):
            if talk[1]["content"] in failing:
                raise RuntimeError("down")
            return f"{name} {talk[1]['content']} ⟦N1⟧"

        return translator

    run = lambda rows, name, *failing: {r.unit_id: (r.status, r.text) for r in translate.translate_kept(rows, answering(name, failing), "s", str(tmp_path / "kept"), parts=3).collect()}
    first = run(rows.where("unit_id <> 'u6'"), "A", "p1", "p2")
    assert first == {f"u{k}": ("needs_repair", "") if k in (1, 2) else ("ok", f"A p{k} ⟦N1⟧") for k in range(6)}
    second = run(rows, "B", "p2")  # asks for what failed and for what is new
    assert second == {f"u{k}": ("ok", f"{'B' if k in (1, 6) else 'A'} p{k} ⟦N1⟧") for k in (0, 1, 3, 4, 5, 6)} | {"u2": ("needs_repair", "")}
    assert run(rows.limit(0), "C") == {}


@pytest.mark.parametrize(
    ("source", "target", "want"),
    [("a 0.95 b 3", "в 0,95 г 4", "в 0.95 г 3"), ("a 0.95", "в 0,95 и 7", "в 0.95 и 7"), ("⟦N1⟧ 1,000", "⟦N1⟧ 1,000", "⟦N1⟧ 1,000"), ("x 5 ⟦C12⟧", "⟦C12⟧ 6 x", "⟦C12⟧ 5 x")],
)
def test_numbers_come_back(spark, source, target, want):
    df = spark.createDataFrame([(source, target)], "s string, t string")
    assert df.select(repair.restore_numbers(F.col("s"), F.col("t"))).first()[0] == want


def test_repair_round(spark):
    units = [unit("d", 0, "score 0.95"), unit("d", 1, "it may be ⟦N1⟧", spans={"⟦N1⟧": ("N", "x", None)}), unit("d", 2, "fine")]
    results = done(spark, [("d", "u001", "ok", "оценка 0,95"), ("d", "u002", "needs_repair", "?"), ("d", "u003", "ok", "хорошо")])
    us = frame(spark, units)

    def check(rows):
        pairs = with_matches(verify.translated_pairs(us, rows), TERMS)
        return verify.union_all(verify.status_issues(rows), verify.unit_issues(pairs, TERMS, LEXICON))

    final, report, left = repair.repair(us, results, check, TERMS, LEXICON, lambda df: df.select("doc_id", "unit_id", F.lit("может быть ⟦N1⟧").alias("draft"), F.lit(None).cast("string").alias("error")))
    assert {r.unit_id: (r.status, r.text, r.repaired) for r in final.collect()} == {"u001": ("ok", "оценка 0.95", "mechanical"), "u002": ("ok", "может быть ⟦N1⟧", "llm"), "u003": ("ok", "хорошо", None)}
    assert {(r["round"], r.unit_id, r.fixed) for r in report.collect()} == {(1, "u001", True), (1, "u002", True)} and left.count() == 0
    final, _, left = repair.repair(us, results, check, TERMS, LEXICON)
    assert {r.unit_id for r in left.collect()} == {"u002"}


def test_citation_changed_to_a_number_that_is_there_is_not_accepted(spark):
    rows = spark.createDataFrame([("1 of 4 [1]", "1 of 4 [4]"), ("1 of 4 [1]", "4 of 1 [1]")], "s string, t string")
    assert [r[0] for r in rows.select(repair.rules_pass(F.col("s"), F.col("t"), R.Lexicon())).collect()] == [False, True]


def test_manual_fix(spark):
    us = frame(spark, [unit("d", 0, "a ⟦N1⟧")])
    results = done(spark, [("d", "u001", "needs_repair", "x")])
    fix = lambda t: spark.createDataFrame([("d", "u001", t)], "doc_id string, unit_id string, text string")
    row = repair.manual_fix(us, results, fix("б ⟦N1⟧")).first()
    assert (row.status, row.text, row.manual) == ("ok", "б ⟦N1⟧", True)
    with pytest.raises(Exception, match="missing placeholders"):
        repair.manual_fix(us, results, fix("б")).collect()


def test_render(spark):
    units = frame(spark, [
        unit("d", 0, "A **b** `c`", kind="title", level=1), unit("d", 1, "", kind="heading", level=2, translate=False, source_md="References", fixed="Список литературы", src_id="r"), unit("d", 2, "", kind="ref", translate=False, source_md="1. A"),
        unit("d", 3, "", kind="ref", translate=False, source_md="2. B"), unit("d", 4, "cap", kind="figure", label="Figure 1", graphics=["a.png", "b.png"]), unit("d", 5, "see ⟦R1⟧", spans={"⟦R1⟧": ("R", "old", "r")}),
    ])
    assert render.render(units).first().body == "# A b c\n\n## References\n\n1. A\n2. B\n\n![Figure 1](assets/a.png)\n\n![Figure 1](assets/b.png)\n\n**Figure 1.** cap\n\nsee old\n"
    results = done(spark, [("d", "u001", "ok", "А"), ("d", "u005", "ok", "подпись"), ("d", "u006", "ok", "см. ⟦R1⟧")])
    assert render.render(units, results).first().body == "# А\n\n## Список литературы\n\n1. A\n2. B\n\n![Рис. 1](assets/a.png)\n\n![Рис. 1](assets/b.png)\n\n**Рис. 1.** подпись\n\nсм. Список литературы\n"
    with pytest.raises(Exception, match="no translation for unit u001"):
        render.render(units, results.where("unit_id <> 'u001'")).collect()


def test_catalogue(spark):
    body = "# **A** of `b`\n\n> note\n" + "слово " * 300 + "```code```"
    rows = [("2020-b", "B", ["X"], 2020, ["nlp"], None, body), ("2021-a", "A", ["Y"], None, ["nlp", "bio"], 3, "x"), ("2020-a", "C", ["Z"], 2020, None, 1, "# T\nx")]
    papers = spark.createDataFrame([dict(zip(("slug", "title", "authors", "year", "topics", "difficulty", "body"), r, strict=True)) | dict.fromkeys(("doi", "pmcid", "arxiv", "pdf", "url", "journal", "license", "status", "difficulty_note")) for r in rows], PAPER)
    c = catalog.records(papers)
    assert {r.slug: (r.title_ru, r.reading_minutes) for r in c.collect()} == {"2020-b": ("A of b", 3 if 301 / 120 > 2.5 else 2), "2021-a": ("A", 1), "2020-a": ("T", 1)}
    slugs = lambda df: [r.slug for r in df.collect()]
    assert slugs(catalog.ordered(c, "year")) == ["2020-a", "2020-b", "2021-a"] and slugs(catalog.ordered(c, "difficulty-desc")) == ["2021-a", "2020-a", "2020-b"]
    assert slugs(catalog.search(c, " NLP ")) == ["2020-b", "2021-a"] and slugs(catalog.search(c, " ")) == [] and len(slugs(catalog.listing(c))) == 3
    assert slugs(catalog.listing(c, topics=["nlp", "bio"])) == ["2021-a"] and [r.topic for r in catalog.facets(c).collect()] == ["bio", "nlp"]


def test_reading_time_rounds_half_to_even(spark):
    df = spark.createDataFrame([("w " * 300,), ("w " * 180,), ("",), (None,)], "b string")
    assert [r[0] for r in df.select(catalog.reading_minutes(F.col("b"))).collect()] == [2, 2, 1, 1]


def test_page_marks(spark):
    html = '<figure> <img src="a"> <figcaption>x</figcaption></figure>\n<p><strong>Рис. 1.</strong> c</p><p><strong>Fig. 2</strong> d</p><img loading="eager" src="b"><a href="q">[3]</a> [4–5]<h2>Список литературы</h2> <ol start="1"><li>doi:10.1/a</li><li id="k"><a href="u">doi:10.2/b</a></li></ol>'
    got = catalog.decorate(spark.createDataFrame([(html,)], "h string"), "h").first().h
    assert got == (
        '<div class="figure-box"><p><img loading="lazy" decoding="async" src="a"></p><p><strong>Рис. 1.</strong> c</p></div><div class="figure-box"><p><strong>Fig. 2</strong> d</p></div><img loading="eager" src="b"><a href="q">[3]</a> '
        '[<a href="#ref-4" class="cite">4</a>–<a href="#ref-5" class="cite">5</a>]<h2>Список литературы</h2> <ol class="references"><li id="ref-1"><a href="https://doi.org/10.1/a">doi:10.1/a</a></li><li id="k"><a href="u">doi:10.2/b</a></li></ol>'
    )


@pytest.mark.parametrize(
    ("message", "n"),
    [("feat: add x", 0), ("feat(core/a): add x\n\nbody", 0), ("", 1), ("# only comment", 1), ("Merge branch 'x'", 0), ("feat: Add x", 1), ("feat: add.", 1), ("feat: add\nbody", 1), ("feat: добавить", 2), ("feat: " + "x" * 80, 2)],
)
def test_messages(spark, message, n):
    assert spark.createDataFrame([(message,)], "m string").select(F.size(validate.message_errors(F.col("m")))).first()[0] == n


def test_validators(spark):
    d = spark.createDataFrame([("3", None), ("0", "x"), (None, None), ("true", None), ("2.5", None), ("5", "  ")], "d string, n string")
    assert [len(r[0]) for r in d.select(validate.difficulty_errors(F.col("d"), F.col("n"))).collect()] == [0, 1, 1, 1, 1, 1]
    t = spark.createDataFrame([("done", "# Title\nx"), ("done", "## a\n# Abstract"), ("done", "x"), ("done", None), (None, "x"), ("done", "# a\n# b"), ("done", "# \n"), ("done", "# **x**")], "s string, b string")
    assert [len(r[0]) for r in t.select(validate.title_errors(F.col("s"), F.col("b"))).collect()] == [0, 2, 1, 1, 0, 1, 1, 1]
    p = spark.createDataFrame([("a", ["x", "y", ""]), ("b", []), ("c", None)], "slug string, topics array<string>")
    got = sorted((r.slug, r.error) for r in validate.topic_errors(p, spark.createDataFrame([("x",)], "topic string")).collect())
    assert [s for s, _ in got] == ["a", "a", "b", "c"]


def test_sinks(spark, tmp_path):
    at = str(tmp_path / "state")
    sinks.append_state(spark, at, "s", "digest", 0)
    sinks.append_state(spark, at, "s", "verify", 2)
    last = sinks.latest_state(spark, at)
    assert [(r.last_step, r.exit_code) for r in last.collect()] == [("verify", 2)]
    assert sinks.read_state_json(sinks.state_json(last)).first().exit_code == 2
    with pytest.raises(Exception, match="(?i)malformed|json"):
        sinks.read_state_json(spark.createDataFrame([("s", "{broken")], "slug string, json string")).collect()


def test_streaming_gate_equals_the_table(spark, tmp_path):
    rows = spark.createDataFrame([("a", "u1", "0.95", "0,95"), ("a", "u2", "not", "не"), ("b", "u1", "not", "да")], "doc_id string, unit_id string, source string, target string")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    gate.write_issues(gate.stream_issues(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, gate.stream_issues(rows).collect()))
    query = gate.stream_gate(stream).writeStream.format("memory").queryName("gate").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("gate").collect())) == [("a", 1, 0), ("b", 1, 0)]


def test_pipeline(spark):
    xml = "<article><front><article-meta><title-group><article-title>A read</article-title></title-group></article-meta></front><body><p>Score 0.95 of LCA.</p></body></article>"
    docs = spark.createDataFrame([("d", xml)], "doc_id string, raw string")
    said = {"A read": "рид (read; фрагмент)", "Score 0.95 of LCA.": "Оценка 0,95 для наименьший общий предок."}
    result = pipeline.run(docs, lambda talk: said[talk[1]["content"].split("Text:\n")[1]], TERMS, LEXICON)
    assert result.gate.first().exit_code == 0, result.issues.collect()
    assert result.bodies.first().body == "# рид (read; фрагмент)\n\nОценка 0.95 для наименьший общий предок.\n"
    assert {r.repaired for r in result.translations.collect()} == {None, "mechanical"}


def test_reviews_pages_and_repair_reports_are_written(spark, tmp_path):
    read = lambda name, key: {r[key]: r.value for r in spark.read.text(str(tmp_path / name), wholetext=True).collect()}
    sinks.write_reviews(spark.createDataFrame([("a", "# R\n\nx"), ("b", "y")], "doc_id string, review string"), str(tmp_path / "reviews"))
    assert {k: v.rstrip("\n") for k, v in read("reviews", "doc_id").items()} == {"a": "# R\n\nx", "b": "y"}
    row = ("2020-a", "T", ["A B"], "10.1/x", None, "https://e.org/", "J", 2020, "CC-BY", "# T\n\nbody")
    papers = spark.createDataFrame([row], "slug string, title string, authors array<string>, doi string, pdf string, url string, journal string, year int, license string, body string")
    sinks.write_index(papers, str(tmp_path / "index"))
    page = read("index", "doc_id")["2020-a"]
    assert page.startswith("# T\n\n> **Неофициальный перевод.**") and "10.1/x" in page and page.rstrip("\n").endswith("body")
    report = spark.createDataFrame([(1, "a", "u001", True), (2, "a", "u002", False)], "round int, doc_id string, unit_id string, fixed boolean")
    sinks.write_repair_report(report, str(tmp_path / "report"))
    assert sorted(map(tuple, spark.read.json(str(tmp_path / "report")).select("round", "doc_id", "unit_id", "fixed").collect())) == sorted(map(tuple, report.collect()))
