"""Row numbers, ordered batches, rejected records and logs of corrections, against plain versions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from folio.operators import updates as U
from folio.operators.ordering import ordered_batches, with_row_index
from folio.sources import records as S


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_row_index_is_dense_and_in_order(spark, n):
    r = random.Random(n)
    rows = [(r.choice([None, *range(40)]), r.choice([None, "a", "b"]), i) for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b string, index_ int").repartition(7)
    got = with_row_index(df, ["a", "b", "index_"]).collect()
    assert sorted(x["index"] for x in got) == list(range(n))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "", x[2])
    assert [tuple(x)[:3] for x in sorted(got, key=lambda x: x["index"])] == sorted(rows, key=key)
    batches = ordered_batches(df, ["a", "b", "index_"], 64).collect()
    assert all((x.batch, x.position) == divmod(sorted(rows, key=key).index(tuple(x)[:3]), 64) for x in batches)


def test_hot_key_is_numbered(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(None,)] * 5, "a int")
    assert sorted(x["index"] for x in with_row_index(df, ["a"]).collect() if x.a == 1) == list(range(5, 505))


def test_upload_batches_are_files_in_order(spark, tmp_path):
    a = lambda l: [(l, "f")] if l else []
    rows = [(f"k{i}", f"t{i}", (a(chr(97 + i * 7 % 26)),) if i % 9 else (None,)) for i in range(53)]
    df = spark.createDataFrame(rows, "record_key string, title string, authors struct<author:array<struct<lname:string,fname:string>>>")
    out = str(tmp_path / "up")
    S.write_upload_batches(S.upload_batches(df, 10), out)
    want = [r[0] for r in sorted(rows, key=lambda r: (bool(r[2][0]), r[2][0][0][0] if r[2][0] else "", r[0]))]
    got = []
    for b in range(6):
        files = [f for f in os.listdir(f"{out}/batch={b}") if f.startswith("part")]
        assert len(files) == 1
        text = open(f"{out}/batch={b}/{files[0]}").read()
        got.append([x.split("</record_key>")[0] for x in text.split("<record_key>")[1:]])
    assert [len(b) for b in got] == [10, 10, 10, 10, 10, 3] and sum(got, []) == want


def test_every_file_gives_a_record_or_a_reject(spark, tmp_path):
    rec = lambda t: f"<DISS_submission><DISS_description><DISS_title>{t}</DISS_title></DISS_description></DISS_submission>"
    files = {
        "good.xml": f"<?xml version='1.0'?><x>{rec('A')}{rec('B')}</x>", "tags.xml": "<x><DISS_submission><DISS_description><DISS_title>D</DISS_titel></DISS_description></DISS_submission></x>",
        "none.xml": "<x><other/></x>", "cut.xml": f"<x>{rec('F')}<DISS_submission><DISS_description>", "hollow.xml": "<x><DISS_submission/></x>", "text.xml": "hello & <", "empty.xml": "",
    }
    for n, t in files.items():
        (tmp_path / n).write_text(t)
    listed = spark.createDataFrame([(f"/delivery/{n}",) for n in files], "path string")
    good, bad = S.accepted_and_rejects(spark, str(tmp_path), delivered=listed)
    assert sorted((r.record_key, r.t) for r in good.select("record_key", F.col("DISS_description.DISS_title").alias("t")).collect()) == [("cut", "F"), ("good", "A"), ("good", "B")]
    got = {(r.record_key, r.reason): r.content for r in bad.collect()}
    assert set(got) == {("tags", S.MALFORMED), ("cut", S.MALFORMED), ("text", S.MALFORMED), ("none", S.NO_RECORD), ("hollow", S.EMPTY), ("empty", S.NO_RECORD)}
    assert "D</DISS_titel>" in got["tags", S.MALFORMED]
    assert S.CORRUPT not in good.columns


RECORD = "record_key string, title string, authors struct<author:array<struct<fname:string,mname:string,lname:string>>>, fields struct<field:array<struct<_name:string,_type:string,value:array<string>>>>"


def test_log_equals_one_correction_at_a_time(spark):
    r = random.Random(8)
    pick = lambda *x: r.choice([None, *x])
    records = []
    for i in range(12):
        fields = [("rights_holder", "string", ["old"])] + ([("major", "string", ["Kept"])] if i % 4 == 0 else [])
        records.append((f"r{i}", f"title {i}", ([("F", "M", "L"), ("G", None, "K")][: r.randint(0, 2)],), (fields,)))
    log = [(r.choice([None, *(f"r{i}" for i in range(13))]), pick(*range(30)), pick("T1", "T2", ""), pick("Ann", ""), pick("None", "", "Q", " "), pick("Lee", "Ray"), pick("", "A; B", ";", "C")) for _ in range(150)]
    schema = "record_key string, seq int, title string, fname string, mname string, lname string, major string"
    once = {}
    for row in log:  # of rows with one number the greatest counts, nulls least
        k = row[:2]
        rank = lambda x: tuple((v is not None, v or "") for v in x[2:])
        if row[0] is not None and (k not in once or rank(row) > rank(once[k])):
            once[k] = row
    base = spark.createDataFrame(records, RECORD)
    for as_of in (None, 15):
        state = base
        steps = sorted((x for x in once.values() if as_of is None or x[1] is None or x[1] <= as_of), key=lambda x: (x[1] is not None, x[1] or 0))
        by_place = {}
        for x in steps:  # a record's n-th correction, for all records at once
            n = sum(y[0] == x[0] for s in by_place.values() for y in s)
            by_place.setdefault(n, []).append(x)
        state = U.apply_corrections(state, spark.createDataFrame([], schema))
        for n in sorted(by_place):
            done = spark.createDataFrame(U.apply_corrections(state, spark.createDataFrame(by_place[n], schema)).collect(), state.schema)
            state = done
        got = U.apply_correction_log(base, spark.createDataFrame(log + log[:40], schema), as_of=as_of)
        assert sorted(map(str, got.select(state.columns).collect())) == sorted(map(str, state.collect()))
