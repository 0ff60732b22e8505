"""Person-name functions: name-part casing, full names, rights holder and
advisor display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, hyphen_title_case, title_case


def name_part(c: Column | str) -> Column:
    """Surname / first / middle name: normalise, title-case, keep the
    capital after a hyphen (``SMITH-JONES`` -> ``Smith-Jones``)."""
    return hyphen_title_case(F.coalesce(col(c), F.lit("")))


def suffix_part(c: Column | str) -> Column:
    """Suffix: title-case only."""
    return title_case(F.coalesce(col(c), F.lit("")))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """First, middle and last name joined by blanks, skipping empty parts."""
    return F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(middle, F.lit("")), F.nullif(last, F.lit("")))


def rights_holder_compat(authors: Column) -> Column:
    """The crosswalk's first rights holder: all first names, all middle
    names, all surnames, all suffixes, each list blank-joined, the four
    lists glued without a separator.  An absent part is skipped, an empty one
    keeps its place."""

    def joined(field: str) -> Column:
        return F.array_join(F.transform(authors, lambda a: a["DISS_name"][field]), " ")

    return F.concat(joined("DISS_fname"), joined("DISS_middle"), joined("DISS_surname"), joined("DISS_suffix"))


def advisor_display(first: Column, middle: Column, last: Column) -> Column:
    """``First Last``, or ``First M. Last`` when there is a middle name."""
    f = F.coalesce(first, F.lit(""))
    m = F.coalesce(middle, F.lit(""))
    l = F.coalesce(last, F.lit(""))
    return F.when(m == "", F.concat(f, F.lit(" "), l)).otherwise(F.concat(f, F.lit(" "), F.substring(m, 1, 1), F.lit(". "), l))


def advisor_slot(advisors: Column, i: int) -> Column:
    """Display name of advisor ``i`` (0-based); NULL when there is none."""
    a = F.get(advisors, i)
    n = a["DISS_name"]
    return F.when(a.isNotNull(), advisor_display(n["DISS_fname"], n["DISS_middle"], n["DISS_surname"]))
