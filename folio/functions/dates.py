"""Date functions: the lenient M/D/YYYY re-format and the embargo rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# --- fixed values -----------------------------------------------------------
NO_EMBARGO = "2001-01-01"
DELAY_OPTIONS = [
    ("No, 6 month delayed release", 180),
    ("No, 1 year delayed release", 365),
    ("No, 2 year delayed release", 730),
]
# ---------------------------------------------------------------------------


def _pad1(c: Column) -> Column:
    return F.when(F.length(c) == 1, F.concat(F.lit("0"), c)).otherwise(c)


def mdy_to_iso(c: Column | str) -> Column:
    """``M/D/YYYY`` -> ``YYYY-MM-DD`` by cutting at the slashes, without
    parsing: month and day get a leading ``0`` only when one character long,
    malformed text passes through (``''`` -> ``--``, ``05/2019`` -> ``-05-``)."""
    s = F.coalesce(col(c), F.lit(""))
    month = F.regexp_extract(s, "(?s)^([^/]*)/", 1)
    day = F.regexp_extract(s, "(?s)^[^/]*/([^/]*)/", 1)
    year = F.regexp_extract(s, "(?s)^[^/]*/[^/]*/(.*)\\z", 1)
    return F.concat(year, F.lit("-"), _pad1(month), F.lit("-"), _pad1(day))


def embargo_date(
    acceptance: Column,
    restrictions: Column,
    access_option: Column,
    decision_date: Column,
    delayed_release: Column,
    options=DELAY_OPTIONS,
) -> Column:
    """Embargo decision tree; returns ``struct<value string, error string>``.

    * acceptance ``0``: a sales restriction that has a code and whose text is
      not ``0`` -> its ``remove`` date re-formatted like ``mdy_to_iso``;
      otherwise no embargo.
    * acceptance ``1`` with an access option: a known delay option and a
      decision date -> decision date (``yyyy-MM-dd HH:mm:ss``) plus the
      delay's days; otherwise no embargo.
    * acceptance ``1`` without option: a delayed-release date -> its first
      ten characters as a date; otherwise no embargo.
    * anything else: no embargo.

    A date that cannot be parsed gives a NULL value and a reason instead of
    failing the job.  ``restrictions`` is ``array<struct<_VALUE,_code,_remove>>``.
    """
    acc = F.coalesce(acceptance, F.lit(""))
    opt = F.coalesce(access_option, F.lit(""))
    dec = F.coalesce(decision_date, F.lit(""))
    rel = F.coalesce(delayed_release, F.lit(""))
    rs = F.coalesce(restrictions, F.array().cast("array<struct<_VALUE:string,_code:string,_remove:string>>"))
    restricted = F.exists(rs, lambda r: r["_code"].isNotNull() & (F.coalesce(r["_VALUE"], F.lit("")) != "0"))
    remove = F.coalesce(F.get(rs, 0)["_remove"], F.lit(""))

    fdate = F.concat(F.substring(dec, 1, 10), F.lit("T"), F.substring(dec, 12, 19))
    ts = F.try_to_timestamp(fdate, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    days = None
    for text, n in options:
        days = (F.when(opt == text, F.lit(n))) if days is None else days.when(opt == text, F.lit(n))
    days = days.otherwise(F.lit(None).cast("int"))
    shifted = F.date_format(F.date_add(F.to_date(ts), days), "yyyy-MM-dd")
    rel_date = F.try_to_date(F.substring(rel, 1, 10), "yyyy-MM-dd")

    none = F.lit(NO_EMBARGO)
    null = F.lit(None).cast("string")
    value = (
        F.when(acc == "0", F.when(restricted, mdy_to_iso(remove)).otherwise(none))
        .when(
            acc == "1",
            F.when(
                opt != "",
                F.when(days.isNotNull() & (dec != ""), shifted).otherwise(none),
            )
            .when(rel != "", F.date_format(rel_date, "yyyy-MM-dd"))
            .otherwise(none),
        )
        .otherwise(none)
    )
    error = (
        F.when((acc == "1") & (opt != "") & days.isNotNull() & (dec != "") & ts.isNull(), F.lit("bad decision date"))
        .when((acc == "1") & (opt == "") & (rel != "") & rel_date.isNull(), F.lit("bad delayed release date"))
        .otherwise(null)
    )
    return F.struct(value.alias("value"), error.alias("error"))
