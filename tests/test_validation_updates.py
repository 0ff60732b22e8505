"""Validation rules, review queue, field edits and corrections."""

import pytest
from pyspark.sql import functions as F

from folio.operators import updates as U
from folio.operators import validation as V


@pytest.mark.parametrize(
    "doc,f,m,l,ok",
    [
        ("Ann Lee", "Ann", "", "Lee", True),
        ("Ann B. Lee", "Ann", "C.", "Lee", True),
        ("Ann de Lee", "Ann", "", "de Lee", True),
        ("ann lee", "Ann", "", "Lee", False),
        ("Ann Lee", "Ann", "", "", False),
        ("Ann  Lee", "Ann", "", "Lee", True),  # split at single blanks: part 3 is the last name
        ("Lee Ann", "Ann", "", "Lee", False),
    ],
)
def test_author_valid(spark, doc, f, m, l, ok):
    df = spark.createDataFrame([(doc, f, m, l)], "d string, f string, m string, l string")
    assert df.select(V.author_valid(F.col("d"), F.col("f"), F.col("m"), F.col("l"))).collect()[0][0] == ok


def test_title_valid_and_error(spark):
    df = spark.createDataFrame([("A Title", "a title"), ("A Title", None)], "r string, d string")
    got = df.select(V.title_valid(F.col("r"), F.col("d")), V.title_score(F.col("r"), F.col("d"))).collect()
    assert got[0][0] is True and got[0][1] == 100
    assert got[1][0] is False and got[1][1] < 100


def test_review_queue_one_pass(spark):
    df = spark.createDataFrame(
        [("r1", "T", "X", False, 10, "Ann Lee", "None", False, "Nope", "review", ["a", "b", "c"]),
         ("r2", "T", "T", True, 100, "Ann Lee", "Ann Lee", True, "Agronomy", "exact", None)],
        "record_key string, title string, doc_title string, title_ok boolean, title_score int, author string, doc_author string, "
        "author_ok boolean, major string, major_status string, suggestions array<string>",
    )
    q = V.review_queue(df).collect()
    assert sorted(r["check"] for r in q) == ["author", "major", "title"]
    assert [r["suggestions"] for r in q if r["check"] == "major"] == [["a", "b", "c"]]


def test_field_edits_idempotent(spark):
    df = spark.createDataFrame([({"k": ["1"]},), ({"k": ["1"], "major": ["Old"]},)], "f map<string,array<string>>")
    once = df.select(U.add_field_if_absent(F.col("f"), "major", F.array(F.lit("New"))).alias("f"))
    twice = once.select(U.add_field_if_absent(F.col("f"), "major", F.array(F.lit("Other"))).alias("f"))
    assert [r[0] for r in once.collect()] == [r[0] for r in twice.collect()]
    assert [r[0]["major"] for r in once.collect()] == [["New"], ["Old"]]
    s = df.select(U.set_field(F.col("f"), "major", F.lit("X")).alias("f")).collect()
    assert "major" not in s[0]["f"] and s[1]["f"]["major"] == ["X"]
    assert df.select(U.field_value_text(F.col("f"), "major")).collect()[0][0] == ""


def test_apply_corrections(spark):
    schema = ("record_key string, title string, authors struct<author:array<struct<fname:string,mname:string,lname:string>>>, "
              "fields struct<field:array<struct<_name:string,_type:string,value:array<string>>>>, department string")
    rec = spark.createDataFrame(
        [("r1", "Old", ([("Ann", "B", "Lee"), ("Bo", "", "Ek")],), ([("language", "string", ["en"]), ("rights_holder", "string", ["AnnBLee", "kept"])],), "d1"),
         ("r2", "Keep", ([("Cy", "", "Do")],), ([("rights_holder", "string", ["CyDo"]), ("major", "string", ["Set"])],), "d2"),
         ("r3", "None", ([],), ([],), "d3"), ("r4", "T", None, None, "d4")], schema)
    cor = spark.createDataFrame(
        [("r1", "New", "Anne", "None", "Leigh", "Agronomy; Physics"), ("r2", None, None, None, None, "Physics"), ("r3", None, None, None, None, "Agronomy"), ("zz", "x", None, None, None, None)],
        "record_key string, title string, fname string, mname string, lname string, major string")
    once = U.apply_corrections(rec, cor)
    out = {r["record_key"]: r for r in once.collect()}
    assert once.columns == rec.columns and len(out) == 4
    assert out["r1"]["title"] == "New" and out["r1"]["department"] == "d1"
    assert [tuple(a) for a in out["r1"]["authors"]["author"]] == [("Anne", "B", "Leigh"), ("Bo", "", "Ek")]  # middle kept on "None"
    fields = lambda r: [(f["_name"], f["value"]) for f in r["fields"]["field"]]
    assert fields(out["r1"]) == [("language", ["en"]), ("rights_holder", ["Anne B Leigh", "kept"]), ("major", ["Agronomy", "Physics"])]
    assert fields(out["r2"]) == [("rights_holder", ["Cy Do"]), ("major", ["Set"])] and out["r2"]["title"] == "Keep"
    assert fields(out["r3"]) == [("major", ["Agronomy"])] and fields(out["r4"]) == []
    again = {r["record_key"]: r for r in U.apply_corrections(once, cor).collect()}
    assert again == out


def test_two_majors_added_once(spark):
    df = spark.createDataFrame([({"k": ["1"]},)], "f map<string,array<string>>")
    two = F.array(F.lit("Agronomy"), F.lit("Physics"))
    once = df.select(U.add_field_if_absent(F.col("f"), "major", two).alias("f"))
    twice = once.select(U.add_field_if_absent(F.col("f"), "major", two).alias("f"))
    assert once.collect()[0][0]["major"] == ["Agronomy", "Physics"] == twice.collect()[0][0]["major"]


def test_fields_to_map_first_wins(spark):
    df = spark.createDataFrame([([("a", "string", ["1"]), ("b", "date", ["2"]), ("a", "string", ["3"])],)], "f array<struct<_name:string,_type:string,value:array<string>>>")
    m = df.select(U.fields_to_map(F.col("f"))).collect()[0][0]
    assert m == {"a": ["1"], "b": ["2"]}


def test_hot_key_paths(spark):
    """One key holding most rows: aggregation with a map-side combine and
    broadcast joins, no per-key collection."""
    from folio.operators import matching as M
    from folio.sources import files

    paths = spark.createDataFrame([(f"/d/hot.{'pdf' if i % 2 else 'mp4'}",) for i in range(3000)] + [("/d/cold.xml",)], "path string")
    comp = {r["record_key"]: (r["has_pdf"], r["n_media"]) for r in files.record_completeness(files.manifest_from_paths(paths)).collect()}
    assert comp["hot"] == (True, 1500) and comp["cold"] == (False, 0)
    auth = spark.createDataFrame([("Agronomy", 0), ("Physics", 1)], "authority_name string, ord long")
    vals = spark.createDataFrame([("AGRONOMY",)] * 3000 + [("Nope",)], "major string")
    out = M.reconcile(vals, "major", auth).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in out} == {"exact": 3000, "review": 1}
