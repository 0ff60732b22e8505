"""Command line: ``python -m folio <command>``.

  crosswalk  --in XML_DIR --out DIR [--institution S] [--url-prefix S]
             [--subjects CSV] [--degrees CSV] [--departments CSV]
             [--schema-location URL]
  review     --records DIR --documents PARQUET --authority CSV --out DIR [--min-lines N] [--pages N] [--exact]
  correct    --records DIR --corrections CSV --out DIR [--schema-location URL]
  publish    --records DIR [DIR ...] --out DIR [--sort-by-name] [--skip N] [--batch-size N] [--schema-location URL]

``documents`` holds ``(record_key, text)`` or a page table ``(record_key,
page_no, text)`` (text extracted elsewhere; the first 11 pages are read unless
``--pages`` says otherwise); ``corrections`` has a header
``record_key,title,fname,mname,lname,major``.  Outputs: target XML records and
the rejects of files that hold none, a review queue and an error report with
its row number (CSV), and one merged upload batch, or with ``--batch-size``
ordered batches of exactly so many records, all written by Spark tasks.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> None:
    from .operators import crosswalk as X
    from .operators import updates as U
    from .operators import validation as V
    from .operators.ordering import with_row_index
    from .plans import quality as Q
    from .sources import files
    from .sources import records as S

    ap = argparse.ArgumentParser(prog="folio")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("crosswalk")
    c.add_argument("--in", dest="inp", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--institution", default=X.CrosswalkConfig.institution)
    c.add_argument("--url-prefix", default=X.CrosswalkConfig.fulltext_prefix)
    c.add_argument("--subjects", help="CSV key,pos,target (one-to-many)")
    c.add_argument("--degrees", help="CSV ord,parts,target (parts separated by |)")
    c.add_argument("--departments", help="CSV key,target")
    r = sub.add_parser("review")
    r.add_argument("--records", required=True)
    r.add_argument("--documents", required=True)
    r.add_argument("--authority", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--min-lines", type=int, default=28)
    r.add_argument("--pages", type=int, default=11)
    r.add_argument("--exact", action="store_true", help="matching-blocks ratio instead of the native score")
    k = sub.add_parser("correct")
    k.add_argument("--records", required=True)
    k.add_argument("--corrections", required=True)
    k.add_argument("--out", required=True)
    p = sub.add_parser("publish")
    p.add_argument("--records", required=True, nargs="+")
    p.add_argument("--out", required=True)
    p.add_argument("--sort-by-name", action="store_true")
    p.add_argument("--skip", type=int, default=0)
    p.add_argument("--batch-size", type=int)
    for x in (c, r, k, p):
        x.add_argument("--schema-location")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("folio").getOrCreate()
    if a.cmd == "crosswalk":
        src, rejects = S.accepted_and_rejects(spark, a.inp)
        rejects.drop("content").write.mode("overwrite").option("header", "true").csv(a.out + "/rejects")
        from .operators import rules as R

        cfg = X.CrosswalkConfig(institution=a.institution, fulltext_prefix=a.url_prefix)
        if a.subjects:
            cfg.subjects = R.one_to_many_from_df(R.load_rules_csv(spark, a.subjects, "key string, pos int, target string"))
        if a.degrees:
            deg = R.load_rules_csv(spark, a.degrees, "ord int, parts string, target string")
            cfg.degrees = R.contains_rules_from_df(deg.select("ord", F.split("parts", "\\|").alias("parts"), "target"))
        if a.departments:
            cfg.departments = R.exact_map_from_df(R.load_rules_csv(spark, a.departments, "key string, target string"))
        out = X.crosswalk(src, cfg, keep=["record_key"])
        S.write_target_records(out.drop("_errors"), a.out + "/records", schema_location=a.schema_location)
        bad = out.select("record_key", "_errors").filter(F.col("_errors").isNotNull())  # reads only what the dates need
        bad.write.mode("overwrite").option("header", "true").csv(a.out + "/errors")
        return
    schema = X.crosswalk(spark.createDataFrame([], X.SOURCE_SCHEMA).withColumn("record_key", F.lit("")), keep=["record_key"]).drop("_errors").schema
    read = lambda folder: S.read_target_records(spark, folder, schema=schema)
    if a.cmd == "review":
        recs = read(a.records)
        docs = spark.read.parquet(a.documents)
        if "page_no" in docs.columns:  # a page table
            docs = files.document_text(docs, a.pages)
        auth = files.read_authority_csv(spark, a.authority)
        checked = Q.check_records(recs, docs, auth, a.min_lines, exact=a.exact)
        V.review_queue(checked).withColumn("suggestions", F.array_join("suggestions", " | ")).write.mode("overwrite").option("header", "true").csv(a.out + "/review_queue")
        S.write_target_records(Q.add_major_field(recs, checked), a.out + "/records", schema_location=a.schema_location)
    elif a.cmd == "correct":
        recs = read(a.records)
        cor = spark.read.option("header", "true").schema("record_key string, title string, fname string, mname string, lname string, major string").csv(a.corrections)
        report = Q.error_report(recs, cor)
        indexed = with_row_index(report, list(report.columns))
        files.write_error_report(indexed.select("index", *report.columns), a.out + "/error_report")
        S.write_target_records(U.apply_corrections(recs, cor), a.out + "/records", schema_location=a.schema_location)
    else:
        merged = S.merge_batches([read(d) for d in a.records], a.sort_by_name, a.skip)
        if a.batch_size:
            S.write_upload_batches(S.upload_batches(merged, a.batch_size), a.out, a.schema_location)
        else:
            S.write_target_records(merged, a.out, schema_location=a.schema_location)


if __name__ == "__main__":
    main()
