"""Quality control of crosswalked records against their documents (the
original's per-record loop, as one plan).

records ⟕ documents on ``record_key`` (one shuffle, or a broadcast when one
side is small) -> title and author best matches, author rules, major from
the document text (whole-value rules) reconciled against the authority list
-> review queue; accepted majors are added to the records' ``fields``.  The
command line and the catalogue's ``review_queue`` run this one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import matching as M
from ..operators import updates as U
from ..operators import validation as V
from ..session import written


def check_records(
    records: DataFrame,
    documents: DataFrame,
    authority: DataFrame,
    min_lines: int = M.MIN_LINES,
    key: str = "record_key",
    exact: bool = False,
) -> DataFrame:
    """``records``: target records (``record_key, title, authors.author``);
    ``documents``: ``(record_key, text)``; ``authority``: ``(authority_name,
    ord)``.  Returns one row per record with the check columns used by
    ``validation.review_queue`` plus ``has_document``.

    ``exact`` searches and checks titles and authors by the matching-blocks
    ratio instead of the native score.  Native searches and scores of large
    tables (``matching.ROOM``) are settled in Arrow passes.  The checked
    records are written once before their unresolved majors meet the list:
    both the queue and the suggestions read them.  The suggestions are written
    too, so that the join on the major has an exchange on either side and the
    one value of all records without a label can be split."""
    a0 = F.get(F.coalesce(F.col("authors.author"), F.array()), 0)
    r = records.select(
        F.col(key),
        F.col("title"),
        F.coalesce(a0["fname"], F.lit("")).alias("fname"),
        F.coalesce(a0["mname"], F.lit("")).alias("mname"),
        F.coalesce(a0["lname"], F.lit("")).alias("lname"),
    )
    d = documents.select(F.col(key), text.text_lines(F.col("text")).alias("lines"), text.find_major(F.col("text")).alias("major"))
    j = r.join(d, key, "left").withColumn("has_document", F.col("lines").isNotNull())
    j = j.withColumn("lines", F.coalesce(F.col("lines"), F.array().cast("array<string>")))
    j = j.withColumn("major", F.coalesce(F.col("major"), F.lit("None")))
    j = j.withColumn("author", names.full_name(F.col("fname"), F.col("mname"), F.col("lname")))
    if exact:
        j = j.withColumn("__t", M.best_line_ratio(F.col("lines"), F.col("title"), min_lines)).withColumn("__a", M.best_line_ratio(F.col("lines"), F.col("author"), min_lines))
    else:
        j = j.withColumn("__stats", M.candidate_stats(F.col("lines"), min_lines))  # once for both searches
        for c, keyword in (("__t", "title"), ("__a", "author")):
            j = j.withColumn(c, M.best_line_native(F.col("lines"), F.col(keyword), min_lines, F.col("__stats"), M.ROOM))
        j = M.settle_native(j.drop("__stats"), "lines", {"__t": "title", "__a": "author"}, min_lines)
    bt, ba = F.col("__t"), F.col("__a")
    j = j.withColumn("doc_title", F.coalesce(bt["text"], F.lit(V.NO_TITLE))).withColumn("doc_author", F.coalesce(ba["text"], F.lit(V.MISSING_PART)))
    j = j.drop("__t", "__a", "lines").withColumn("title_score", V.title_score(F.col("title"), F.col("doc_title"), exact, None if exact else M.ROOM))
    if not exact:
        j = M.settle_scores(j, "title_score", *V.title_pair(F.col("title"), F.col("doc_title")))
    j = j.withColumn("title_ok", F.col("title_score") == 100)
    j = j.withColumn("author_ok", V.author_valid(F.col("doc_author"), F.col("fname"), F.col("mname"), F.col("lname")))
    j = M.reconcile(j, "major", authority).withColumnRenamed("status", "major_status").withColumnRenamed("resolved", "major_resolved")
    j = written(j, "checked")
    top = M.suggestions(j.filter(F.col("major_status") == "review"), "major", authority, k=3)
    named = top.groupBy(F.col("value").alias("__major")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "suggestion"))), lambda t: t["suggestion"]).alias("suggestions"))
    named = written(named, "suggestions")
    return j.join(named, (F.col("major_status") == "review") & (F.col("major") == F.col("__major")), "left").drop("__major")


def add_major_field(records: DataFrame, checked: DataFrame, key: str = "record_key") -> DataFrame:
    """Insert a ``major`` field (resolved value, two for a pair) into records
    that have none yet; records without a resolved major are unchanged."""
    m = checked.select(F.col(key), F.col("major_resolved").alias("__major"))
    fields = F.coalesce(F.col("fields.field"), F.array())
    new = U.add_entry_if_absent(fields, "major", U.major_values(F.col("__major")))
    return records.join(m, key, "left").withColumn("fields", F.struct(new.alias("field"))).drop("__major")


def error_report(records: DataFrame, corrections: DataFrame, key: str = "record_key") -> DataFrame:
    """Records with a correction, as they were, next to it; characters that
    the report's readers cannot show are repaired."""
    a0 = F.get(F.col("authors.author"), 0)
    part = lambda c: F.coalesce(a0[c], F.lit(""))
    j = records.join(corrections.select(key, F.col("title").alias("__t"), F.col("fname").alias("__f"), F.col("mname").alias("__m"), F.col("lname").alias("__l")), key)
    return j.filter(F.col("__t").isNotNull() | F.col("__l").isNotNull()).select(
        F.concat(key, F.lit("-out.xml")).alias("file"),
        text.repair_chars(F.col("title")).alias("title"),
        F.col("__t").alias("title_correction"),
        text.repair_chars(names.full_name(part("fname"), part("mname"), part("lname"))).alias("author"),
        F.when(F.col("__l").isNotNull(), F.concat_ws(" ", "__f", "__m", "__l")).alias("author_correction"),
    )
