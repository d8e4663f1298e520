import pytest
from pyspark.sql import functions as F

from unitloom.sources import glossary, jats, landing, latexml, pdf_lines
from unitloom.sources.inline import Protector, masked

XML = """<!DOCTYPE pmc-articleset PUBLIC "-//X" "https://x/y.dtd"><pmc-articleset><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta>
<title-group><article-title>On <italic>Escherichia coli</italic> and <italic>k</italic>-mers</article-title></title-group>
<abstract id="abs"><p>We use Kraken <sup><xref ref-type="bibr" rid="b1">1</xref>,<xref ref-type="bibr" rid="b2">2</xref></sup> at 10<sup>3</sup>.</p></abstract></article-meta></front>
<body><sec id="s1"><title>Methods</title><p id="p1">See [<xref ref-type="bibr" rid="b1">1</xref>, <xref ref-type="bibr" rid="b2">2</xref>] and <xref ref-type="sec" rid="s2">below</xref> or <xref ref-type="fig" rid="f1">Fig. 1</xref>.<fig id="f1"><label>Fig. 1</label><caption><p>A <bold>cap</bold></p></caption><graphic xlink:href="img/f1.jpg"/></fig></p>
<sec id="s2"><title>Inner</title><p>Link <ext-link xlink:href="https://e.org/a%3e">https://e.org/a&gt;</ext-link> with <inline-formula><tex-math>$x^2$</tex-math></inline-formula> and <monospace>cmd</monospace>.</p><table-wrap><caption><p>gone</p></caption></table-wrap></sec></sec>
<ack><title>Thanks</title><p>All.</p></ack></body>
<back><ref-list id="rl"><ref id="b1"><label>1</label><element-citation><person-group person-group-type="author"><name><surname>Doe</surname><given-names>J</given-names></name></person-group><article-title>On
 x</article-title><source>J Y</source><year>2020</year><volume>3</volume><fpage>1</fpage><lpage>9</lpage><pub-id pub-id-type="doi">10.1/a</pub-id></element-citation></ref>
<ref id="b2"><label>2.</label><mixed-citation><name><surname>Roe</surname><given-names>K</given-names></name> Text doi: <pub-id pub-id-type="doi">10.2/b</pub-id>.</mixed-citation></ref></ref-list></back>
<floats-group><fig id="f1"><caption><p>again</p></caption></fig><fig id="f2"><label>Fig. 2</label><caption><p>Second</p></caption></fig></floats-group></article></pmc-articleset>"""


@pytest.fixture(scope="module")
def units(spark):
    return jats.digest(spark.createDataFrame([("d", XML)], "doc_id string, raw string"), protected={"terms": ["Kraken"]}).orderBy("ordinal").collect()


def test_digest_order_and_kinds(units):
    assert [(u.kind, u.level) for u in units] == [("title", 1), ("heading", 2), ("para", None), ("heading", 2), ("para", None), ("figure", None), ("heading", 3), ("para", None), ("heading", 2), ("para", None), ("heading", 2), ("ref", None), ("ref", None), ("figure", None)]
    assert [u.unit_id for u in units][:2] == ["u001", "u002"] and units[1].fixed == "Аннотация" and not units[1].translate
    assert units[5].label == "Fig. 1" and units[5].graphics == ["f1.jpg"] and units[13].src_id == "f2"


def test_masks_restore_the_markdown(spark, units):
    assert units[0].text == "On ⟦N1⟧ and ⟦V1⟧-mers" and units[0].source_md == "On *Escherichia coli* and *k*-mers"
    assert units[2].text == "We use ⟦N1⟧ ⟦C1⟧ at 10⟦U1⟧." and units[2].source_md == "We use Kraken [1,2] at 10<sup>3</sup>."
    assert units[4].text == "See ⟦C1⟧ and ⟦R1⟧ or ⟦F1⟧." and units[4].source_md == "See [1, 2] and below or Fig. 1." and units[4].spans["⟦R1⟧"].rid == "s2"
    assert units[7].source_md == "Link [https://e.org/a](https://e.org/a) with $x^2$ and `cmd`."
    for u in units:
        back = u.text
        for key, span in u.spans.items():
            back = back.replace(key, span.md)
        assert not u.translate or back == u.source_md


def test_references(units):
    assert units[11].source_md == "1. Doe J. On x. J Y. 2020;3:1–9. doi:10.1/a"
    assert units[12].source_md == "2. Roe K Text doi:10.2/b."


def test_broken_documents(spark):
    docs = spark.createDataFrame([(1, XML), (2, "<x"), (3, "<html/>"), (4, None), (5, "<!ENTITY a><article/>")], "doc_id long, raw string")
    got = {r.doc_id: r.valid for r in jats.validate_articles(docs).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert jats.digest(docs, on_error="keep").where("error is not null").count() == 4
    with pytest.raises(Exception, match="ParseError|ValueError"):
        jats.digest(docs).collect()


def text_of(xml):
    return masked(jats.parse_xml(xml), Protector())[2]


@pytest.mark.parametrize(
    ("xml", "md"),
    [
        ("<p>a [<xref ref-type='bibr'>1</xref>] b</p>", "a [1] b"), ("<p>a [<xref ref-type='bibr'>1</xref>–<xref ref-type='bibr'>3</xref>][<xref ref-type='bibr'>4</xref>]</p>", "a [1–3][4]"),
        ("<p>[<xref ref-type='bibr'>1</xref> see]</p>", "[[1] see]"), ("<p>x<disp-formula>y  z</disp-formula>w</p>", "x\n\n```\ny z\n```\n\nw"), ("<p>a <italic>long words here</italic> b</p>", "a *long words here* b"),
        ("<p><italic>Homo sapiens</italic></p>", "*Homo sapiens*"), ("<p>a <disp-formula><tex-math>\\begin $$x$$</tex-math></disp-formula> b</p>", "a\n\n$$x$$\n\nb"), ("<p>H<sub>2</sub>O</p>", "H<sub>2</sub>O"),
    ],
)
def test_inline_rules(xml, md):
    assert text_of(xml) == md


HTML = """<html><body><nav><a href="/">x</a></nav><article class="ltx_document"><h1 class="ltx_title_document">My <em>Title</em></h1><div class="ltx_abstract" id="ab"><p>Abs <b>bold</b></p></div>
<section id="S1" class="ltx_section"><h2><span class="ltx_tag">1</span>One</h2><div class="ltx_para"><p class="ltx_p">A [<a href="#bib.b1">1</a>] <a href="#S1.F1">Fig</a> <a href="#S2">Sec</a><br>next <math alttext="x^2"></math><svg>no</svg></p></div>
<section class="ltx_subsection"><h3>Sub</h3><p class="ltx_p">B</p></section><figure id="S1.F1" class="ltx_figure"><object data="a/b.png"></object><figcaption>Cap</figcaption></figure><table><tr><td>1</td><td>2</td></tr></table></section>
<section class="ltx_bibliography"><h2>References</h2><ul><li id="bib.b1" class="ltx_bibitem"><span class="ltx_tag ltx_tag_bibitem">[1]</span> Someone</li></ul></section></article></body>"""


def test_latexml(spark):
    got = latexml.digest_html(spark.createDataFrame([(1, HTML), (2, "<p>x")], "doc_id long, html string")).orderBy("doc_id", "ordinal").collect()
    assert got[-1].error.startswith("not a LaTeXML")
    rows = got[:-1]
    assert [(r.kind, r.source_md) for r in rows] == [
        ("title", "My*Title*"), ("heading", "Abstract"), ("para", "Abs **bold**"), ("heading", "One"), ("para", "A [1] Fig Sec next $x^2$"), ("heading", "Sub"), ("para", "B"), ("figure", "Cap"), ("para", "12"), ("heading", "References"), ("ref", "[1] [1] Someone"),
    ]
    assert rows[4].text == "A ⟦C1⟧ ⟦F1⟧ ⟦R1⟧ next ⟦M1⟧" and rows[7].graphics == ["b.png"]


def test_pdf_lines(spark):
    lines = ["Some Long Title Of Work about things", "Jane Doe", "a@b.org", "Abstract", "We do", "things.", "1", "Introduction", "First line of a wrapped para-", "graph ends here.", "New one", "12", "1.1", "Details", "Inner text", "Figure 2: A cap-", "tion end.", "Table 1: Scores of all", "Method x", "[1] A. Author. Paper", "continued", "[2] B."]
    got = pdf_lines.digest_lines(spark.createDataFrame([(1, lines)], "doc_id long, lines array<string>")).orderBy("ordinal").collect()
    assert [(r.kind, r.source_md) for r in got] == [
        ("title", "Some Long Title Of Work about things"), ("heading", "Abstract"), ("para", "We do things."), ("heading", "1 Introduction"), ("para", "First line of a wrapped paragraph ends here."), ("para", "New one"),
        ("heading", "1.1 Details"), ("para", "Inner text"), ("figure", "A cap- tion end."), ("para", "[Table 1] Scores of all"), ("para", "Method x"), ("heading", "References"), ("ref", "1. [1] A. Author. Paper continued"), ("ref", "2. [2] B."),
    ]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines[8:12])], "doc_id long, pos int, line string")
    assert [r.text for r in pdf_lines.joined_paragraphs(df, ["doc_id"]).orderBy("paragraph").collect()] == pdf_lines.joined(lines[8:11])


def test_normal_lines(spark):
    df = spark.createDataFrame([("ﬁne ﬂow\n\n  co­op \r\nx",)], "t string")
    assert df.select(pdf_lines.normal_lines(F.col("t"))).first()[0] == ["fine flow", "coop", "x"]


@pytest.mark.parametrize(("number", "title", "ok"), [("1", "Introduction", True), ("13", "Far", False), ("2", "lower case", False), ("2.1", "lower case", True), ("3", "One, two", False), ("3", "Table of x", False), ("4", "12 cats", False), ("4", "See [3]", False), ("5", "A b c d e f g", False), ("6", "123", False)])
def test_section_headings(spark, number, title, ok):
    df = spark.createDataFrame([(number, title)], "n string, t string")
    assert df.select(pdf_lines.is_section_heading(F.col("n"), F.col("t"))).first()[0] is ok
    kinds = spark.createDataFrame([([number, title],)], "l array<string>").select(pdf_lines.line_kinds(F.col("l"))).first()[0]
    assert (kinds[0] == pdf_lines.HEADING) is ok


def test_dispatch_and_identifiers(spark):
    rows = [("a", "PMC1", "2001.00001", None), ("b", None, "2001.00001v2", "https://x"), ("c", "", None, "https://x"), ("d", None, None, "http://x"), ("e", None, None, None)]
    got = {r.slug: (r.source_kind, r.source_url, r.source_error) for r in landing.dispatched(spark.createDataFrame(rows, "slug string, pmcid string, arxiv string, pdf string")).collect()}
    assert got["a"][0] == "pmcid" and got["a"][1].endswith("id=1") and got["b"][1].endswith("/html/2001.00001v2") and got["c"][:2] == ("pdf", "https://x")
    assert got["d"][2] == "pdf must be an https URL" and got["e"][2] == "no pmcid, arxiv, or pdf"
    for bad in ("PMC", "pmc1", "PMC1x", "1"):
        with pytest.raises(Exception, match="bad PMCID"):
            spark.createDataFrame([(bad,)], "p string").select(landing.pmc_url(F.col("p"))).collect()


def test_images_and_candidates(spark):
    data = [(b"\xff\xd8\xff\xe0", True), (b"\x89PNG\r\n\x1a\n", True), (b"GIF89a", True), (b"GIF88a", False), (b"  <SVG>", True), (b"<html><svg>", False), (b"", False)]
    df = spark.createDataFrame([(bytearray(d), i) for i, (d, _) in enumerate(data)], "b binary, i int")
    assert [r[0] for r in df.orderBy("i").select(landing.is_image(F.col("b"))).collect()] == [x for _, x in data]
    pages = spark.createDataFrame([(1, "PMC7", '<img src="/x/F1_HTML.jpg"><a href="https://c.org/f1.png?q"><img src="http://c.org/f1.gif"><img src="F1_HTML.jpg"><img src="other.jpg">')], "doc_id long, pmcid string, html string")
    wanted = spark.createDataFrame([(1, "F1.jpg")], "doc_id long, filename string")
    assert [r.url for r in landing.candidate_graphics(pages, wanted).orderBy("pos").collect()] == ["https://pmc.ncbi.nlm.nih.gov/x/F1_HTML.jpg", "https://c.org/f1.png?q", "https://pmc.ncbi.nlm.nih.gov/articles/PMC7/F1_HTML.jpg"]


def test_glossary(spark, tmp_path):
    table = "x\n| Термин | p | q |\n|---|:--:|---|\n| lowest common ancestor (LCA) | наименьший общий предок (НОП), предок | смысл |\n| read | рид | при первом употреблении пояснить |\n| OTU | ОТЕ | не расшифровывать |\n| a | b |\n"
    rows = glossary.parse_table(spark.createDataFrame([(table,)], "markdown string")).orderBy("pos")
    terms = glossary.collect_terms(rows)
    assert [t.en for t in terms] == [("lowest common ancestor", "LCA"), ("read",), ("OTU",), ("a",)]
    assert terms[0].ru == ("наименьший общий предок", "предок") and terms[0].gloss == "смысл" and not terms[0].wants_parenthesis
    assert terms[1].note and terms[1].first_form == "рид (read)" and terms[2].paren_en == "never"
    glossary.write_terms(rows.drop("pos"), str(tmp_path / "terms"))
    assert sorted(t.label for t in glossary.collect_terms(glossary.read_terms(spark, str(tmp_path / "terms")))) == ["OTU", "a", "lowest common ancestor (LCA)", "read"]


def test_folder_of_papers(spark, tmp_path):
    def paper(slug, meta, body=None):
        (tmp_path / slug).mkdir()
        (tmp_path / slug / "meta.json").write_text(meta)
        if body is not None:
            (tmp_path / slug / "index.md").write_text(body)

    paper("2019-old", '{"title": "Old", "year": 2019,\n "status": "published"}', "# Old\n\nbody\n")
    paper("2021-new", '{"title": "New", "year": 2021, "status": "reviewed", "slug": "other"}', "# New\n")
    paper("2020-no-body", '{"title": "B", "year": 2020, "status": "published"}')
    paper("Draft", '{"title": "D", "status": "not-started"}', "# D\n")
    (tmp_path / "notes.md").write_text("not a paper")
    got = landing.published(landing.scan_papers(spark, str(tmp_path))).select("slug", "title", "body").collect()
    assert [tuple(r) for r in got] == [("2021-new", "New", "# New\n"), ("2019-old", "Old", "# Old\n\nbody\n")]
    paper("Bad_Slug", '{"title": "X", "status": "published"}', "# X\n")
    with pytest.raises(Exception, match="bad slug"):
        landing.published(landing.scan_papers(spark, str(tmp_path))).collect()


def test_long_batches_are_worked_in_slices(spark):
    import pyarrow as pa

    from unitloom.session import slices

    batch = pa.RecordBatch.from_pydict({"k": list(range(1000)), "t": ["x" * 10] * 999 + ["y" * (3 << 20)]})
    parts = list(slices([batch, batch.slice(0, 0)]))
    assert max(p.num_rows for p in parts) <= 256 and pa.Table.from_batches(parts).column("k").to_pylist() == list(range(1000))
    raw = "<article><front><article-meta><title-group><article-title>T</article-title></title-group></article-meta></front><body><p>P</p></body></article>"
    docs = spark.range(0, 700, 1, 1).select(F.col("id").alias("doc_id"), F.lit(raw).alias("raw"))
    sizes = jats.digest(docs).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
    assert sorted(jats.digest(docs).groupBy("doc_id").count().select("count").distinct().collect()) == [(2,)] and sum(r.n for r in sizes.collect()) == 1400
