"""Stand-in inputs built from the driver's tables.

The driver's tables hold no thesis records, so each query first shapes rows
of a table into the schema its operator expects (a title, a name, a date
string, a file path, ...).  These functions only give rows that schema; they
do none of the operator's work.  The oracle SQL builds the same inputs.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (input shaping only) ---------------------------------------
FILE_EXTENSIONS = ["pdf", "xml", "PDF", "mp4", "xml"]
LABEL_BY_LANG = {"en": "Major: ", "fr": "Co-Majors: ", "es": "majors: "}
VOWEL_SHIFT = ("aeiou", "eioua")
CHAR_SOURCE = "abcdefghijk"
CHAR_TARGET = "\u201c\u201d\u2019\u2018\u2212\u03b2\u2013\u03b3\u0301\u0306\u0131"
# ------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """Read a driver table.  For CPU-heavy per-row work (edit distances,
    XML writing) pass ``heavy=True``: if the caller's session names a number
    of partitions in ``spark.folio.text.partitions`` (for inputs of very few
    splits, such as one small file), the rows are dealt to so many tasks.
    Unset, every query reads the scan's own splits - no shuffle."""
    from ..operators.partitioning import PARTITIONS, spread

    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    n = spark.conf.get(PARTITIONS, None) if heavy else None
    return spread(df, int(n) if n else None)


def first_line(c: Column) -> Column:
    return F.get(F.split(c, "\n", -1), 0)


def rest(words: Column, i: int) -> Column:
    """The words from the ``i``-th on (0-based), joined; empty without any."""
    return F.array_join(F.slice(words, i + 1, F.greatest(F.size(words), F.lit(1))), " ")


def word(c: Column, i: int) -> Column:
    return F.get(F.split(c, " ", -1), i)
