import pytest
from pyspark.sql import functions as F

from unitloom.functions import rules as R
from unitloom.functions import text as X

LEXICON = R.Lexicon(banned=(("имплементация", "реализация"),))


def issues(spark, source, target, rule=R.unit_rules):
    df = spark.createDataFrame([(source, target)], "s string, t string")
    return [(i.check, i.severity, i.message) for i in df.select(rule(F.col("s"), F.col("t"), LEXICON).alias("i")).first().i]


@pytest.mark.parametrize(
    ("source", "target"),
    [("score 0.95", "оценка 0.59"), ("1000 reads", "100 ридов"), ("p < 0.001", "p значимо"), ("many reads", "42 рида"), ("shift −5", "сдвиг -5"), ("5–10 kb", "5-10 kb"), ("score 0.95", "оценка 0,95")],
)
def test_changed_numbers_fail(spark, source, target):
    assert [c for c, s, _ in issues(spark, source, target, R.numbers)] == ["numbers"]


@pytest.mark.parametrize(
    ("source", "target"),
    [("1,000 reads", "1 000 ридов"), ("5 % of 10", "5% из 10"), ("5% of 10", "5 % из 10"), ("3 reads", "три рида"), ("2 and 2", "2"), ("⟦N1⟧ 7", "7 ⟦N1⟧"), ("10 kb", "десять kb"), ("1,234,567", "1 234 567")],
)
def test_equal_numbers_pass(spark, source, target):
    assert issues(spark, source, target, R.numbers) == []


def test_number_message(spark):
    assert issues(spark, "a 0.95 b 7", "a 0.59", R.numbers) == [("numbers", "FAIL", "numbers differ: lost ['0.95', '7'] added ['0.59']")]


def test_negation(spark):
    assert issues(spark, "it is not so", "это так", R.negation) == [("negation", "FAIL", "negation lost")]
    assert issues(spark, "it is so", "Это НЕ так", R.negation)[0][1] == "WARN"
    assert issues(spark, "it doesn't hold", "верно", R.negation) == []  # no word boundary before n't
    assert issues(spark, "absence of reads", "отсутствие ридов", R.negation) == []


def test_hedging_reports_the_first_lost_hedge_only(spark):
    assert issues(spark, "it may likely hold", "верно", R.hedging) == [("hedging", "WARN", "hedge 'may' not found in translation")]
    assert issues(spark, "maybe", "верно", R.hedging)[0][2].startswith("hedge 'may'")  # hedges are prefixes
    assert issues(spark, "it holds", "это доказывает", R.hedging) == [("hedging", "WARN", "translation is stronger than the source")]
    assert issues(spark, "it shows", "это доказывает", R.hedging) == [] == issues(spark, "it may hold", "возможно", R.hedging)


def test_untranslated_compares_letters_with_words(spark):
    rule = lambda s, t, lexicon: R.untranslated(t, lexicon)
    assert issues(spark, "", "one two three four five six", rule) and not issues(spark, "", "one two three four five", rule)
    assert not issues(spark, "", "one two three four five six словечко", rule) and issues(spark, "", "one two three four five six да", rule)


def test_banned_words(spark):
    rule = lambda s, t, lexicon: R.banned(t, lexicon)
    assert issues(spark, "", "Имплементация и имплементацияхх", rule)[1][2] == "'имплементацияхх' → use 'реализация'"
    assert issues(spark, "", "имплементация (то есть реализация)", rule) == []
    assert len(issues(spark, "", "имплементация (" + "х" * 40 + "реализация)", rule)) == 1


def test_body_rules(spark):
    body = lambda s, t, _: R.body_rules(s, t)
    assert [c for c, *_ in issues(spark, "see https://a.org/x and doi:10.1093/abc", "doi:10.1093/abc https://a.org/x", body)] == ["links"]
    assert [c for c, *_ in issues(spark, "[1] [2, 3]", "[1] [2,3]", body)] == ["citations"]
    assert [c for c, *_ in issues(spark, "t\n## References\n\nA\nB", "t\n## Список литературы\n\nA", body)] == ["references"]
    assert issues(spark, "t\n## References\n\nA\n", "t\n## Список литературы\nA", body) == []
    assert len(issues(spark, "", "⟦N1⟧" * 9, body)) == 5


@pytest.mark.parametrize(
    ("got", "error"),
    [("⟦C1⟧ b ⟦N1⟧", None), ("⟦N1⟧", "missing placeholders: ⟦C1⟧"), ("⟦N1⟧⟦N1⟧⟦C1⟧", "duplicated placeholders: ⟦N1⟧"), ("⟦N9⟧", "unknown placeholders: ⟦N9⟧")],
)
def test_placeholder_bags(spark, got, error):
    df = spark.createDataFrame([("⟦N1⟧ a ⟦C1⟧", got)], "s string, t string")
    assert df.select(X.placeholder_error(F.col("t"), F.col("s"))).first()[0] == error
    from unitloom.operators.translate import bag_error

    assert bag_error(got, "⟦N1⟧ a ⟦C1⟧") == error


def test_unmasking(spark):
    df = spark.sql("select 'a ⟦N1⟧ in ⟦R1⟧ ⟦X9⟧' as t, map('⟦N1⟧', named_struct('type', 'N', 'md', '$x$', 'rid', cast(null as string)), '⟦R1⟧', named_struct('type', 'R', 'md', 'Sec', 'rid', 's1')) as s, map('s1', 'Глава') as h")
    row = df.select(X.unmask(F.col("t"), F.col("s")).alias("a"), X.unmask(F.col("t"), F.col("s"), F.col("h")).alias("b")).first()
    assert (row.a, row.b) == ("a $x$ in Sec ⟦X9⟧", "a $x$ in Глава ⟦X9⟧")
    with pytest.raises(Exception, match="unknown placeholder"):
        df.select(X.unmask_strict(F.col("t"), F.col("s"))).collect()


def test_protected_terms(spark):
    df = spark.createDataFrame([("MetaPhlAn4 and MetaPhlAn, NC_12.3 but notBLAST",)], "t string")
    m = df.select(X.mask_protected(F.col("t"), ["MetaPhlAn", "MetaPhlAn4", "BLAST"], [r"NC_\d+(?:\.\d+)?"]).alias("m")).first().m
    assert m.text == "⟦N1⟧ and ⟦N2⟧, ⟦N3⟧ but notBLAST" and [m.spans[f"⟦N{k}⟧"].md for k in (1, 2, 3)] == ["MetaPhlAn4", "MetaPhlAn", "NC_12.3"]


@pytest.mark.parametrize(("word", "stem"), [("Геном", "ген"), ("вида", "вид"), ("рид", "рид"), ("последовательность", "последовательнос")])
def test_stems(spark, word, stem):
    assert spark.createDataFrame([(word,)], "w string").select(X.stem(F.col("w"))).first()[0] == stem


def test_stems_must_all_be_present(spark):
    df = spark.createDataFrame([("общий предок", "Ближайшего общего *предка*"), ("общий предок", "общий родитель")], "a string, t string")
    assert [r[0] for r in df.select(X.all_stems_present(F.col("a"), F.col("t"))).collect()] == [True, False]
