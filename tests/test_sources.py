"""Readers and writers: XML records, authority CSV, manifest, merge, stream."""

import os
import tempfile

from pyspark.sql import functions as F

from folio.operators.crosswalk import CrosswalkConfig, crosswalk
from folio.sources import files
from folio.sources import records as S

SOURCE_XML = """<?xml version="1.0"?>
<deliveries>
<DISS_submission>
  <DISS_authorship><DISS_author type="primary">
    <DISS_name><DISS_surname>SMITH-JONES</DISS_surname><DISS_fname>ann</DISS_fname><DISS_middle/></DISS_name>
    <DISS_contact type="current"><DISS_email>a@example.org</DISS_email></DISS_contact>
    <DISS_contact type="future"><DISS_email>b@example.org</DISS_email></DISS_contact>
  </DISS_author></DISS_authorship>
  <DISS_description page_count="007" type="doctoral">
    <DISS_title>GROWTH OF CORN-BASED FUELS</DISS_title>
    <DISS_dates><DISS_comp_date>2019</DISS_comp_date><DISS_accept_date>1/2/2019</DISS_accept_date></DISS_dates>
    <DISS_degree>Ph.D.</DISS_degree>
    <DISS_institution><DISS_inst_contact>Food &amp; Soil</DISS_inst_contact></DISS_institution>
    <DISS_advisor><DISS_name><DISS_fname>Jo</DISS_fname><DISS_middle>Quinn</DISS_middle><DISS_surname>Doe</DISS_surname></DISS_name></DISS_advisor>
    <DISS_categorization>
      <DISS_category><DISS_cat_desc>Aging</DISS_cat_desc></DISS_category>
      <DISS_keyword>a, b;c; d</DISS_keyword><DISS_language>en</DISS_language>
    </DISS_categorization>
  </DISS_description>
  <DISS_content>
    <DISS_abstract><DISS_para>Abstract</DISS_para><DISS_para>x &lt;bold&gt;k&lt;/bold&gt;</DISS_para></DISS_abstract>
    <DISS_binary>Smith_1.pdf</DISS_binary>
  </DISS_content>
  <DISS_restriction><DISS_sales_restriction code="1" remove="1/2/2020"/></DISS_restriction>
  <DISS_repository><DISS_acceptance>0</DISS_acceptance></DISS_repository>
</DISS_submission>
</deliveries>
"""


def test_xml_crosswalk_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="folio-test-")
    with open(os.path.join(d, "Smith_1_DATA.xml"), "w") as f:
        f.write(SOURCE_XML)
    src = S.read_source_records(spark, d)
    cfg = CrosswalkConfig(subjects={"Aging": ["Gerontology", "Family, Life Course, and Society"]})
    out = crosswalk(src, cfg, keep=["record_key"])
    r = out.collect()[0]
    assert r["record_key"] == "Smith_1"
    assert r["title"] == "Growth Of Corn-Based Fuels"
    assert r["publication-date"] == "2019-01-02"
    a = r["authors"]["author"][0]
    assert (a["lname"], a["fname"], a["mname"], a["email"]) == ("Smith-Jones", "Ann", "", "a@example.org")
    assert r["disciplines"]["discipline"] == ["Gerontology", "Family, Life Course, and Society"]
    assert r["keywords"]["keyword"] == ["a", "b,c", "d"]
    assert r["abstract"]["p"] == ["x <strong>k</strong> "]
    assert r["department"] == "Food and Soil"
    assert r["document-type"] == "dissertation"
    fields = {f["_name"]: f["value"][0] for f in r["fields"]["field"]}
    assert fields["embargo_date"] == "2020-01-02"
    assert fields["file_size"] == "007 pages"
    assert fields["rights_holder"] == "annSMITH-JONES"
    assert fields["advisor1"] == "Jo Q. Doe"
    out_dir = os.path.join(d, "out")
    target = out.drop("_errors")
    S.write_target_records(target, out_dir)
    back = S.read_target_records(spark, out_dir, schema=target.schema).collect()[0]
    assert back["title"] == r["title"] and back["keywords"] == r["keywords"]
    assert back["fields"]["field"][3]["_type"] == "date"


def test_batches_written_per_folder(spark):
    d = tempfile.mkdtemp(prefix="folio-test-")
    df = spark.createDataFrame([("a", f"t{i}", "hot" if i % 3 else "cold") for i in range(30)], "record_key string, title string, batch string")
    S.write_target_records(df.repartition(4), os.path.join(d, "out"), batch_col="batch", max_records_per_file=5)
    assert sorted(os.listdir(os.path.join(d, "out")))[:2] == ["_SUCCESS", "batch=cold"] or "batch=hot" in os.listdir(os.path.join(d, "out"))
    hot = S.read_target_records(spark, os.path.join(d, "out", "batch=hot"), schema="record_key string, title string")
    assert hot.count() == 20
    files = [f for f in os.listdir(os.path.join(d, "out", "batch=hot")) if f.startswith("part-")]
    assert len(files) >= 4  # the hot batch is written by several tasks, files capped at 5 records


def test_authority_csv(spark):
    d = tempfile.mkdtemp(prefix="folio-test-")
    p = os.path.join(d, "majors.csv")
    with open(p, "w") as f:
        f.write('Accounting\n"Apparel, Merchandising, and Design"\nAgronomy\nAgronomy\n')
    a = files.read_authority_csv(spark, p).orderBy("ord").collect()
    assert [r["authority_name"] for r in a] == ["Accounting", "Apparel, Merchandising, and Design", "Agronomy", "Agronomy"]


def test_manifest_scan(spark):
    d = tempfile.mkdtemp(prefix="folio-test-")
    for name in ["A_1.xml", "A_1.pdf", "B_2.XML"]:
        open(os.path.join(d, name), "w").write("x")
    os.makedirs(os.path.join(d, "A_1"))
    open(os.path.join(d, "A_1", "clip.mp4"), "w").write("x")
    m = files.scan_manifest(spark, d)
    kinds = {r["name"]: r["kind"] for r in m.collect()}
    assert kinds == {"A_1.xml": "xml", "A_1.pdf": "pdf", "B_2.XML": "xml", "clip.mp4": "media"}
    comp = {r["record_key"]: (r["has_xml"], r["has_pdf"]) for r in files.record_completeness(m).collect()}
    assert comp["A_1"] == (True, True) and comp["B_2"] == (True, False)


def test_document_text_first_pages(spark):
    pages = spark.createDataFrame([("k", i, f"p{i} ") for i in range(15)], "record_key string, page_no int, text string")
    t = files.document_text(pages).collect()[0]["text"]
    assert t == "".join(f"p{i} " for i in range(11))


def test_merge_skip_and_sort(spark):
    a = spark.createDataFrame([(f"k{i:02d}", f"t{i}") for i in range(0, 10)], "record_key string, title string")
    b = spark.createDataFrame([(f"k{i:02d}", f"t{i}") for i in range(10, 20)], "record_key string, title string")
    out = S.merge_batches([a, b], skip=3)
    assert sorted(r["record_key"] for r in out.collect()) == [f"k{i:02d}" for i in range(3, 20)]
    same = spark.createDataFrame([("k1", "a"), ("k1", "b"), ("k1", "b"), ("k2", "c"), (None, "d"), ("k3", None)], "record_key string, title string")
    rest = lambda n: sorted((tuple(r) for r in S.merge_batches([same], skip=n).collect()), key=str)
    assert rest(2) == [("k1", "b"), ("k1", "b"), ("k2", "c"), ("k3", None)]  # rows, not keys
    assert rest(3) == [("k1", "b"), ("k2", "c"), ("k3", None)] and rest(9) == []


def test_error_report_csv(spark):
    d = tempfile.mkdtemp(prefix="folio-test-")
    df = spark.createDataFrame([("f.xml", "T", "T2", "A", None)], "file string, title string, title_correction string, author string, author_correction string")
    files.write_error_report(df, os.path.join(d, "report"))
    back = spark.read.option("header", "true").csv(os.path.join(d, "report")).collect()
    assert back[0]["title_correction"] == "T2"


def test_streaming_crosswalk(spark):
    from folio.streaming.deliveries import start_crosswalk_stream

    d = tempfile.mkdtemp(prefix="folio-test-")
    inp, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))
    os.makedirs(inp)
    with open(os.path.join(inp, "Smith_1_DATA.xml"), "w") as f:
        f.write(SOURCE_XML)
    with open(os.path.join(inp, "Bad_2_DATA.xml"), "w") as f:
        f.write(SOURCE_XML.replace("<DISS_acceptance>0</DISS_acceptance>", "<DISS_acceptance>1</DISS_acceptance><DISS_delayed_release>soon</DISS_delayed_release>"))
    q = start_crosswalk_stream(spark, inp, out, ck, available_now=True)
    q.awaitTermination(120)
    t = S.read_target_records(spark, out + "/batch=*")
    assert {r.title for r in t.select("title").collect()} == {"Growth Of Corn-Based Fuels"} and t.count() == 2
    bad = spark.read.option("header", "true").csv(out + "/errors/batch=*").collect()
    assert [(r["record_key"], r["_errors"]) for r in bad] == [("Bad_2", "bad delayed release date")]


def test_merge_sort_by_name(spark):
    schema = "record_key string, authors struct<author:array<struct<lname:string,fname:string>>>"
    a = spark.createDataFrame([("k1", ([("Zed", "Ann")],)), ("k2", ([("Abel", "Bo")],))], schema)
    b = spark.createDataFrame([("k3", ([("Abel", "Al")],))], schema)
    out = S.merge_batches([a, b], sort_by_name=True).collect()
    assert [r["record_key"] for r in out] == ["k3", "k2", "k1"]


def test_cli_crosswalk_review_correct(spark):
    from folio.__main__ import main

    d = tempfile.mkdtemp(prefix="folio-cli-")
    os.makedirs(os.path.join(d, "in"))
    with open(os.path.join(d, "in", "Smith_1_DATA.xml"), "w") as f:
        f.write(SOURCE_XML)
    with open(os.path.join(d, "subjects.csv"), "w") as f:
        f.write("key,pos,target\nAging,1,Society\nAging,0,Gerontology\n")
    with open(os.path.join(d, "degrees.csv"), "w") as f:
        f.write("ord,parts,target\n0,Ph.D.,Doctor of Philosophy\n")
    with open(os.path.join(d, "depts.csv"), "w") as f:
        f.write("key,target\nSoil,Agronomy\n")
    main(["crosswalk", "--in", os.path.join(d, "in"), "--out", os.path.join(d, "cw"), "--subjects", os.path.join(d, "subjects.csv"),
          "--degrees", os.path.join(d, "degrees.csv"), "--departments", os.path.join(d, "depts.csv")])
    lines = ["Growth Of Corn-Based Fuels", "by", "Ann Smith-Jones", "Major: Agronomy (Crop Production)"] + [f"line {i}" for i in range(30)]
    spark.createDataFrame([("Smith_1", "\n".join(lines))], "record_key string, text string").write.parquet(os.path.join(d, "docs"))
    with open(os.path.join(d, "majors.csv"), "w") as f:
        f.write('Agronomy\n"Apparel, Merchandising, and Design"\n')
    main(["review", "--records", os.path.join(d, "cw", "records"), "--documents", os.path.join(d, "docs"),
          "--authority", os.path.join(d, "majors.csv"), "--out", os.path.join(d, "rv")])
    queue = spark.read.option("header", "true").csv(os.path.join(d, "rv", "review_queue")).collect()
    assert [r["check"] for r in queue] == []  # title, author and major all validate
    from folio.operators.crosswalk import SOURCE_SCHEMA, crosswalk
    schema = crosswalk(spark.createDataFrame([], SOURCE_SCHEMA).withColumn("record_key", F.lit("")), keep=["record_key"]).drop("_errors").schema
    rec = S.read_target_records(spark, os.path.join(d, "rv", "records"), schema=schema).collect()[0]
    assert {f["_name"]: f["value"][0] for f in rec["fields"]["field"]}["major"] == "Agronomy"
    assert rec["disciplines"]["discipline"] == ["Gerontology", "Society"]
    assert rec["degree_name"] == "Doctor of Philosophy" and rec["department"] == "Food and Soil"
    with open(os.path.join(d, "corr.csv"), "w") as f:
        f.write("record_key,title,fname,mname,lname,major\nSmith_1,Growth of Corn-Based Fuels,Anne,None,Smith-Jones,Physics; Botany\n")
    main(["correct", "--records", os.path.join(d, "cw", "records"), "--corrections", os.path.join(d, "corr.csv"), "--out", os.path.join(d, "fx")])
    rep = spark.read.option("header", "true").csv(os.path.join(d, "fx", "error_report")).collect()[0]
    assert rep["title"] == "Growth Of Corn-Based Fuels" and rep["title_correction"] == "Growth of Corn-Based Fuels"
    assert rep["author"] == "Ann Smith-Jones" and rep["author_correction"] == "Anne None Smith-Jones"
    # publish: one batch of whole records
    url = "http://example.org/schema.xsd"
    main(["publish", "--records", os.path.join(d, "fx", "records"), os.path.join(d, "cw", "records"), "--out", os.path.join(d, "batch"), "--sort-by-name", "--schema-location", url])
    main(["publish", "--records", os.path.join(d, "cw", "records"), "--out", os.path.join(d, "batches"), "--batch-size", "1"])
    assert all(len([f for f in os.listdir(os.path.join(d, "batches", b)) if f.startswith("part")]) == 1 for b in os.listdir(os.path.join(d, "batches")) if b.startswith("batch="))
    out = S.read_target_records(spark, os.path.join(d, "batch"), schema=schema).collect()
    assert len(out) == 2
    was = next(r for r in out if r["title"] == "Growth Of Corn-Based Fuels")
    now = next(r for r in out if r["title"] == "Growth of Corn-Based Fuels")
    for column in schema.names:
        if column not in ("title", "authors", "fields"):
            assert now[column] == was[column], column
    assert now["abstract"] is not None and now["keywords"] is not None and now["department"] is not None
    fields = lambda r: {f["_name"]: f["value"] for f in r["fields"]["field"]}
    assert fields(now) == {**fields(was), "rights_holder": ["Anne Smith-Jones"], "major": ["Physics", "Botany"]}
    assert {a["_xsi:type"] for r in out for a in r["authors"]["author"]} == {"individual"}
    files_out = [f for f in os.listdir(os.path.join(d, "batch")) if f.startswith("part-")]
    text_out = "".join(open(os.path.join(d, "batch", f)).read() for f in files_out)
    assert f'xsi:noNamespaceSchemaLocation="{url}"' in text_out.replace("'", '"') and '<author xsi:type="individual">' in text_out


def test_quality_plan_flags_mismatches(spark):
    from folio.plans import quality as Q
    from folio.operators import validation as V

    recs = spark.createDataFrame(
        [("r1", "A Study Of Corn", ([("Ann", "", "Lee")],), ([],)), ("r2", "Other", ([("Bo", "", "Ek")],), ([],))],
        "record_key string, title string, authors struct<author:array<struct<fname:string,mname:string,lname:string>>>, "
        "fields struct<field:array<struct<_name:string,_type:string,value:array<string>>>>",
    )
    docs = spark.createDataFrame([("r1", "A Study of Wheat\nAnn Lee\nMajor: Agronomi\nx\ny")], "record_key string, text string")
    auth = spark.createDataFrame([("Agronomy", 0), ("Anthropology", 1), ("Astronomy", 2), ("Physics", 3)], "authority_name string, ord long")
    checked = Q.check_records(recs, docs, auth, min_lines=4)
    q = {(r["record_key"], r["check"]): r for r in V.review_queue(checked).collect()}
    assert ("r1", "title") in q and ("r1", "author") not in q
    assert q[("r1", "major")]["suggestions"][0] == "Agronomy"
    assert q[("r2", "title")]["document_value"] == "Error"  # no document: the title cannot validate
    assert ("r2", "author") in q
    assert [f["_name"] for f in Q.add_major_field(recs, checked).filter("record_key = 'r1'").collect()[0]["fields"]["field"]] == []


def test_advisor_slots_default_and_compat(spark):
    adv = "".join(
        f"<DISS_advisor><DISS_name><DISS_fname>F{i}</DISS_fname><DISS_middle>{'M' if i == 2 else ''}</DISS_middle><DISS_surname>S{i}</DISS_surname></DISS_name></DISS_advisor>"
        for i in (1, 2, 3)
    )
    xml = SOURCE_XML.replace(
        "<DISS_advisor><DISS_name><DISS_fname>Jo</DISS_fname><DISS_middle>Quinn</DISS_middle><DISS_surname>Doe</DISS_surname></DISS_name></DISS_advisor>", adv
    )
    d = tempfile.mkdtemp(prefix="folio-test-")
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write(xml)
    src = S.read_source_records(spark, d)
    full = {f["_name"]: f["value"][0] for f in crosswalk(src).collect()[0]["fields"]["field"]}
    assert (full["advisor1"], full["advisor2"], full["advisor3"]) == ("F1 S1", "F2 M. S2", "F3 S3")
    two = {f["_name"] for f in crosswalk(src, CrosswalkConfig(max_advisors=2)).collect()[0]["fields"]["field"]}
    assert "advisor2" in two and "advisor3" not in two
