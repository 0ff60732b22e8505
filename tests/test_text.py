"""Golden cases for the string, date and name functions (both modes where
the original output is kept as an option)."""

import pytest
from conftest import one
from pyspark.sql import functions as F

from folio.functions import dates, names, text
from folio.operators import rules as R


def ev(spark, fn, value):
    return spark.createDataFrame([(value,)], "s string").select(fn(F.col("s")).alias("v")).collect()[0]["v"]


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("SMITH-JONES", "Smith-Jones"),
        ("McDonald", "Mcdonald"),
        ("van der Berg", "Van Der Berg"),
        ("O'BRIEN", "O'brien"),
        ("  ann   marie ", "Ann Marie"),
        ("", ""),
        ("A - B", "A - B"),
    ],
)
def test_name_case(spark, raw, expected):
    assert ev(spark, names.name_part, raw) == expected


def test_title_field(spark):
    assert ev(spark, text.title_field, "GROWTH OF CORN-BASED FUELS") == "Growth Of Corn-Based Fuels"
    assert ev(spark, lambda c: text.title_field(c, compat=True), "GROWTH OF CORN-BASED FUELS") == (
        "GROWTH OF CORN-BASED FUELSGrowth Of Corn-Based Fuels"
    )
    assert ev(spark, text.title_field, " A <i>study</i>  of x ") == "A <i>study</i> of x"
    assert ev(spark, text.title_field, "TEST <B>X</B> Y") == "Test X Y"


@pytest.mark.parametrize("raw,expected", [("a<b", "a"), ("<a<b>c", "c"), ("x<I>y</I>z", "xyz"), ("a<b\n", "a")])
def test_strip_tags(spark, raw, expected):
    assert ev(spark, text.strip_tags, raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("1/2/2019", "2019-01-02"), ("12/31/2018", "2018-12-31"), ("2019-01-02", "--"), ("", "--"), ("05/2019", "-05-")],
)
def test_mdy(spark, raw, expected):
    assert ev(spark, dates.mdy_to_iso, raw) == expected


def test_title_case_idempotent_ascii(spark):
    once = ev(spark, text.title_case, "the QUICK brown-fox")
    assert ev(spark, text.title_case, once) == once


@pytest.mark.parametrize("raw,expected", [("a, b;c; d", ["a", "b,c", "d"]), ("a, ", ["a", ""]), ("", [])])
def test_keywords(spark, raw, expected):
    assert ev(spark, text.split_keywords, raw) == expected


def test_abstract(spark):
    df = spark.createDataFrame(
        [(["Abstract", "<bold>k</bold> x<super>2</super> <underline>u</underline>"],)], "p array<string>"
    )
    assert df.select(text.abstract_paragraphs(F.col("p")).alias("v")).collect()[0]["v"] == ["<strong>k</strong> x<sup>2</sup> u "]


@pytest.mark.parametrize("raw,expected", [("doctoral", "dissertation"), ("Masters", "thesis"), ("other", "other")])
def test_doc_type(spark, raw, expected):
    assert ev(spark, text.doc_type, raw) == expected


def test_clean_and_lines(spark):
    assert ev(spark, text.clean_text, "a\tb\n\n\n\nc") == "ab\n\nc"
    assert ev(spark, text.text_lines, "a\tb\n\n\n\nc  \n d") == ["ab", "", "c", "d"]
    assert ev(spark, text.text_lines, "  ") == []


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("Major: Agronomy (Crop)", "Agronomy "),
        ("Co-majors: A; B", "A; B"),
        ("Co-Majors: A (x) B (y) C", "A  C"),
        ("Majors: Z", "None"),
        ("x\nMajor: First\nMajor: Second", "Second"),
        ("Major:", ""),
    ],
)
def test_find_major(spark, raw, expected):
    assert ev(spark, lambda c: text.find_major(c, compat=True), raw) == expected  # the cascade keeps the blank


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("Major: Materials Science & Engineering (PhD)", "Materials Science and Engineering"),
        ("Major: Materials Science", "Materials Science and Engineering"),
        ("Major: Nutritional Sciences", "Nutritional Sciences"),
        ("Co-majors: A; B (x)", "A; B"),
        ("no label", "None"),
    ],
)
def test_find_major_whole_value(spark, raw, expected):
    assert ev(spark, text.find_major, raw) == expected


def test_record_key(spark):
    for path, key in [("/a/Smith_1_DATA.xml", "Smith_1"), ("/a/Smith_1_DATA-out.xml", "Smith_1"), ("Smith_1.pdf", "Smith_1"), ("X_DATA_2.xml", "X_DATA_2")]:
        assert ev(spark, text.record_key, path) == key


def test_replace_chain_modes(spark):
    raw = "Materials Science & Engineering"
    assert ev(spark, text.replace_chain, raw) == "Materials Science and Engineering and Engineering"
    assert ev(spark, lambda c: text.replace_chain(c, compat=False), raw) == "Materials Science and Engineering"
    assert ev(spark, text.replace_chain, "Nutritional Sciences") == "Nutritional Sciencess"
    assert ev(spark, lambda c: text.replace_chain(c, compat=False), "Nutritional Sciences") == "Nutritional Sciences"


def test_repair_chars(spark):
    raw = "“q” ’ − β γ á ı"
    assert ev(spark, text.repair_chars, raw) == "\"q\" ' - b (&#947) a' i"


def test_match_key(spark):
    assert ev(spark, text.match_key, "Apparel, Merchandising, and Design") == "apparel  merchandising  and design"
    assert ev(spark, text.match_key, " Food-Science! ") == "food science"


def test_record_key(spark):
    assert ev(spark, text.record_key_from_path, "/x/XML-Transformed/Smith_1_DATA-out.xml") == "Smith_1.pdf"
    assert ev(spark, text.stem, "/x/a.b.xml") == "a.b"


def test_advisor(spark):
    df = spark.createDataFrame([("Jane", "", "Doe"), ("Jane", "Quinn", "Doe")], "f string, m string, l string")
    got = [r[0] for r in df.select(names.advisor_display(F.col("f"), F.col("m"), F.col("l"))).collect()]
    assert got == ["Jane Doe", "Jane Q. Doe"]


def test_full_name_skips_empty(spark):
    df = spark.createDataFrame([("Ann", "", "Lee")], "f string, m string, l string")
    assert df.select(names.full_name(F.col("f"), F.col("m"), F.col("l"))).collect()[0][0] == "Ann Lee"


# -- rule tables ------------------------------------------------------------------
DEGREES = [
    R.ContainsRule(("M.S.", "M.B.A."), "Master of Science/Master of Business Administration"),
    R.ContainsRule(("M.A.",), "Master of Arts"),
    R.ContainsRule(("M.A.T.",), "Master of Arts in Teaching"),
    R.ContainsRule(("Ph.D.",), "Doctor of Philosophy"),
]


def test_ordered_contains_first_match(spark):
    f = lambda c: R.ordered_contains(c, DEGREES)
    assert ev(spark, f, "M.A.T.") == "Master of Arts"  # shadowed rule
    assert ev(spark, f, "M.S. and M.B.A.") == "Master of Science/Master of Business Administration"
    assert ev(spark, f, "Ed.D.") == "Ed.D."
    g = lambda c: R.ordered_contains(c, DEGREES, longest_match=True)
    assert ev(spark, g, "M.A.T.") == "Master of Arts in Teaching"


def test_exact_map_escape(spark):
    m = {"Engineering Mechanics": "Aerospace Engineering", "Food Science & Human Nutrition": "never"}
    f = lambda c: R.exact_map(c, m)
    assert ev(spark, f, "Food Science & Human Nutrition") == "Food Science and Human Nutrition"
    assert ev(spark, f, "Engineering Mechanics") == "Aerospace Engineering"
    assert ev(spark, f, "Physics") == "Physics"


def test_one_to_many(spark):
    m = {"Aging": ["Gerontology", "Family, Life Course, and Society"]}
    df = spark.createDataFrame([(["Aging", "no such subject", "aging"],)], "c array<string>")
    got = df.select(R.one_to_many_array(F.col("c"), m)).collect()[0][0]
    assert got == ["Gerontology", "Family, Life Course, and Society", "no such subject", "aging"]
    long = df.select(F.posexplode("c").alias("cat_pos", "category"))
    out = R.one_to_many_join(long, "category", R.one_to_many_rules_df(spark, m), "d").orderBy("cat_pos", "tgt_pos")
    assert [r["d"] for r in out.collect()] == got


def test_rules_from_csv(spark, tmp_path):
    deg = tmp_path / "degrees.csv"
    deg.write_text("ord,parts,target\n0,M.S.|M.B.A.,MS/MBA\n1,M.A.,Master of Arts\n")
    df = R.load_rules_csv(spark, str(deg), "ord int, parts string, target string").select("ord", F.split("parts", "\\|").alias("parts"), "target")
    rules = R.contains_rules_from_df(df)
    assert rules == [R.ContainsRule(("M.S.", "M.B.A."), "MS/MBA"), R.ContainsRule(("M.A.",), "Master of Arts")]
    assert ev(spark, lambda c: R.ordered_contains(c, rules), "M.S. and M.B.A.") == "MS/MBA"
    sub = tmp_path / "subjects.csv"
    sub.write_text("key,pos,target\nAging,0,Gerontology\nAging,1,Society\n")
    rules_df = R.load_rules_csv(spark, str(sub), "key string, pos int, target string")
    long = spark.createDataFrame([(0, "Aging"), (1, "Other")], "cat_pos int, category string")
    out = R.one_to_many_join(long, "category", rules_df, "d").orderBy("cat_pos", "tgt_pos").collect()
    assert [r["d"] for r in out] == ["Gerontology", "Society", "Other"]


def test_rule_loaders(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "key string, target string")
    assert R.exact_map_from_df(df) == {"a": "x", "b": "z"}
    m = spark.createDataFrame([("a", 1, "second"), ("a", 0, "first")], "key string, pos int, target string")
    assert R.one_to_many_from_df(m) == {"a": ["first", "second"]}
