"""Record updates: applying corrections and editing the ``fields`` list.

The original rewrote an XML file per edit; here each edit is a column
expression, and corrections arrive as a table joined on the record key.
Every update is idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, text

FIELD_VALUES = "map<string,array<string>>"


def fields_to_map(fields: Column) -> Column:
    """``array<struct<_name,_type,value>>`` -> ``map<name, values>`` (first
    occurrence of a name wins)."""
    dedup = F.filter(
        F.transform(fields, lambda f, i: F.struct(f["_name"].alias("k"), f["value"].alias("v"), i.alias("i"))),
        lambda e: F.array_position(F.transform(fields, lambda g: g["_name"]), e["k"]) == e["i"] + 1,
    )
    return F.map_from_entries(F.transform(dedup, lambda e: F.struct(e["k"], e["v"])))


def field_exists(fields: Column, name: str) -> Column:
    return F.coalesce(F.map_contains_key(fields, F.lit(name)), F.lit(False))


def field_value_text(fields: Column, name: str) -> Column:
    """First value of the named field, or ``''``."""
    return F.coalesce(F.get(F.try_element_at(fields, F.lit(name)), 0), F.lit(""))


def set_field(fields: Column, name: str, value: Column) -> Column:
    """Overwrite the first value of an existing field; absent fields stay
    absent."""
    return F.transform_values(
        fields,
        lambda k, v: F.when((k == name) & (F.size(v) > 0), F.concat(F.array(value), F.slice(v, 2, F.greatest(F.size(v), F.lit(1))))).otherwise(v),
    )


def add_field_if_absent(fields: Column, name: str, values: Column) -> Column:
    """Insert a field when absent (idempotent): one value for a major, two for
    a double major."""
    return F.when(field_exists(fields, name), fields).otherwise(F.map_concat(fields, F.create_map(F.lit(name), values)))


# -- the same edits on a record's own ``fields`` list --------------------------------
def set_entry(fields: Column, name: str, value: Column) -> Column:
    """Overwrite the first value of the first entry called ``name``; a list
    without it, and an entry without values, stay as they are."""
    at = F.array_position(F.transform(fields, lambda f: f["_name"]), name)

    def edit(f: Column, i: Column) -> Column:
        values = F.concat(F.array(value), F.slice(f["value"], 2, F.greatest(F.size(f["value"]), F.lit(1))))
        return F.when((i + 1 == at) & (F.size(f["value"]) > 0), f.withField("value", values)).otherwise(f)

    return F.transform(fields, edit)


def add_entry_if_absent(fields: Column, name: str, values: Column) -> Column:
    """Append an entry of type string unless the list has one of that name,
    or ``values`` is NULL or empty (idempotent)."""
    entry = F.struct(F.lit(name).alias("_name"), F.lit("string").alias("_type"), values.alias("value"))
    wanted = ~F.exists(fields, lambda f: f["_name"] == name) & (F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0)
    return F.when(wanted, F.concat(fields, F.array(entry))).otherwise(fields)


def major_values(major: Column) -> Column:
    """One value for a major, two for a double one (``first; second``)."""
    return F.filter(F.transform(F.split(major, ";", -1), text.py_strip), lambda m: m != "")


CORRECTION_COLUMNS = ("title", "fname", "mname", "lname", "major")


def apply_corrections(records: DataFrame, corrections: DataFrame, key: str = "record_key") -> DataFrame:
    """Apply a corrections table ``(record_key, title, fname, mname, lname,
    major)`` to target records, keeping every other column.

    Only the first author changes; a middle name changes only when the
    correction is non-empty and not ``None``; the ``rights_holder`` entry of
    ``fields`` becomes the first author's full name, in every record that has
    an author; a corrected major is added to ``fields`` when there is none.
    Of several corrections of a record the greatest row counts.  One left
    join on the key (the planner broadcasts a small corrections table)."""
    held = {"title": "__t", "fname": "__f", "mname": "__m", "lname": "__l", "major": "__j"}
    one = corrections.groupBy(key).agg(F.max(F.struct(*CORRECTION_COLUMNS)).alias("__c"))
    # the first author beside the list: what only needs that one does not take the list through the join
    first = records.withColumn("__a", F.get(F.coalesce(F.col("authors.author"), F.array()), 0))
    j = first.join(one.select(key, *[F.col(f"__c.{c}").alias(h) for c, h in held.items()]), key, "left")
    keep_mid = F.col("__m").isNull() | F.col("__m").isin("", " ", "None")

    a = F.col("__a")
    fixed = a.withField("fname", F.coalesce("__f", a["fname"])).withField("mname", F.when(~keep_mid, F.col("__m")).otherwise(a["mname"])).withField("lname", F.coalesce("__l", a["lname"]))
    out = j.withColumn("title", F.coalesce(F.col("__t"), F.col("title"))).withColumn("__a", fixed)
    a0, rest = F.col("__a"), F.coalesce(F.col("authors.author"), F.array())
    out = out.withColumn("authors", F.struct(F.when(a0.isNull(), rest).otherwise(F.concat(F.array(a0), F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))))).alias("author")))
    holder = names.full_name(F.coalesce(a0["fname"], F.lit("")), F.coalesce(a0["mname"], F.lit("")), F.coalesce(a0["lname"], F.lit("")))
    fields = F.coalesce(F.col("fields.field"), F.array())
    fields = F.when(a0.isNotNull(), set_entry(fields, "rights_holder", holder)).otherwise(fields)
    out = out.withColumn("fields", F.struct(add_entry_if_absent(fields, "major", major_values(F.col("__j"))).alias("field")))
    return out.drop("__a", *held.values())


LOG_COLUMNS = ("title", "fname", "mname", "lname", "major")


def apply_correction_log(records: DataFrame, log: DataFrame, key: str = "record_key", seq: str = "seq", as_of: int | None = None) -> DataFrame:
    """Records after a log of corrections ``(record_key, seq, title, fname,
    mname, lname, major)`` was applied to them one row at a time, in order of
    ``seq``; ``as_of``: only up to that number.

    Each edit keeps the last value that it accepts, or the first: a title or
    name part is overwritten by every later one that is not NULL, a middle name
    by those that are neither empty nor ``None``, and a major is only added to
    a record that has none, so the first one stays.  The whole log of a record
    thus folds to one row by aggregates that combine on the map side, whatever
    its length.  The ``rights_holder`` follows the final name.

    Replays change nothing: rows of one record and number count once (of
    different ones the greatest).  Rows without a number come before all
    others; NULL keys match no record."""
    rows = log.filter(F.col(key).isNotNull()) if as_of is None else log.filter(F.col(key).isNotNull() & (F.coalesce(F.col(seq), F.lit(as_of)) <= as_of))
    once = rows.groupBy(key, F.col(seq).alias("__n")).agg(F.max(F.struct(*LOG_COLUMNS)).alias("c")).select(key, "__n", "c.*")
    at = F.struct(F.col("__n").isNotNull(), F.col("__n"))  # nulls first
    taken = lambda c, ok, pick: pick(F.when(ok, F.struct(at.alias("at"), F.col(c).alias("v")))).alias(f"__{c}")
    given = {c: F.col(c).isNotNull() for c in LOG_COLUMNS}
    given["mname"] = given["mname"] & ~F.col("mname").isin("", " ", "None")
    given["major"] = F.size(F.coalesce(major_values(F.col("major")), F.array().cast("array<string>"))) > 0
    folded = once.groupBy(key).agg(*[taken(c, given[c], F.min if c == "major" else F.max) for c in LOG_COLUMNS])
    return apply_corrections(records, folded.select(key, *[F.col(f"__{c}.v").alias(c) for c in LOG_COLUMNS]), key)
