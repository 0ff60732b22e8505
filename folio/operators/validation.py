"""Validation of a record against its document, and the review queue that
replaces the original's interactive prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fuzzy, names, text

# --- fixed values -----------------------------------------------------------
MISSING_PART = "None"  # a name part the document does not have
MISSING_PAIR = "False"  # two-part surname when the document name has < 3 parts
NO_TITLE = "Error"  # document title when no candidate exists
# ---------------------------------------------------------------------------


def title_valid(record_title: Column, doc_title: Column, exact: bool = False) -> Column:
    """The title check: a score of 100, which long titles also reach with a
    small difference (rounding)."""
    return title_score(record_title, doc_title, exact) == 100


def title_pair(record_title: Column, doc_title: Column) -> tuple[Column, Column]:
    """What the title check compares."""
    return F.lower(F.coalesce(doc_title, F.lit(NO_TITLE))), F.lower(F.coalesce(record_title, F.lit("None")))


def title_score(record_title: Column, doc_title: Column, exact: bool = False, room: int | None = None) -> Column:
    """0..100; 100 when equal ignoring case.  ``exact`` uses the matching-
    blocks ratio (Python UDF) instead of the native score, which is NULL for
    titles whose table takes more than ``room`` cells."""
    a, b = title_pair(record_title, doc_title)
    s = fuzzy.ratio_score(a, b) if exact else fuzzy.lev_score(a, b, room)
    return F.when(a == b, F.lit(100)).otherwise(s)


def doc_name_parts(doc_author: Column) -> Column:
    """Document name split at single blanks: ``struct<p0,p1,p2,pair12>``
    with ``None`` for missing parts and ``False`` for a missing pair."""
    parts = F.split(F.coalesce(doc_author, F.lit(MISSING_PART)), " ", -1)

    def part(i: int) -> Column:
        return F.coalesce(F.get(parts, i), F.lit(MISSING_PART))

    pair = F.when(F.size(parts) >= 3, F.concat(F.get(parts, 1), F.lit(" "), F.get(parts, 2))).otherwise(F.lit(MISSING_PAIR))
    return F.struct(part(0).alias("p0"), part(1).alias("p1"), part(2).alias("p2"), pair.alias("pair12"))


def _eq(doc_part: Column, name: Column) -> Column:
    """Score-100 test of one name part: equal after stripping the document
    side; an empty or missing record side never matches."""
    return F.coalesce((F.coalesce(name, F.lit("")) != "") & (text.py_strip(doc_part) == name), F.lit(False))


def author_valid(doc_author: Column, fname: Column, mname: Column, lname: Column) -> Column:
    """Valid when the first part is the first name and the last name is the
    third part, the second part, or parts two and three together; or when
    the whole document name equals the record's full name.  The middle
    name never decides."""
    p = doc_name_parts(doc_author)
    full = names.full_name(F.coalesce(fname, F.lit("")), F.coalesce(mname, F.lit("")), F.coalesce(lname, F.lit("")))
    first_ok = _eq(p["p0"], fname)
    last_ok = _eq(p["p2"], lname) | _eq(p["p1"], lname) | _eq(p["pair12"], lname)
    permissive = _eq(F.coalesce(doc_author, F.lit(MISSING_PART)), full)
    return (first_ok & last_ok) | permissive


def review_queue(checked: DataFrame, key: str = "record_key") -> DataFrame:
    """Long form ``record_key, check, source_value, document_value, score,
    suggestions`` with one row per failed check, built in one pass over
    ``checked`` (an array of failed checks per record, then ``explode``).
    ``checked`` has columns ``title, doc_title, title_ok, title_score,
    author, doc_author, author_ok, major, major_status, suggestions``."""
    empty = F.array().cast("array<string>")
    null_s, null_i = F.lit(None).cast("string"), F.lit(None).cast("int")

    def check(name, value, doc, score, sugg):
        return F.struct(F.lit(name).alias("check"), value.alias("source_value"), doc.alias("document_value"), score.alias("score"), sugg.alias("suggestions"))

    items = F.array(
        F.when(~F.col("title_ok"), check("title", F.col("title"), F.col("doc_title"), F.col("title_score").cast("int"), empty)),
        F.when(~F.col("author_ok"), check("author", F.col("author"), F.col("doc_author"), null_i, empty)),
        F.when(F.col("major_status") == "review", check("major", F.col("major"), null_s, null_i, F.coalesce(F.col("suggestions"), empty))),
    )
    out = checked.select(key, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("c"))
    return out.select(key, "c.check", "c.source_value", "c.document_value", "c.score", "c.suggestions")
