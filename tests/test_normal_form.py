import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from folio.functions.normal_form import nfkd


def both(spark, strings):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string").repartition(8).select("i", nfkd(F.col("s")).alias("d")).collect()
    return [r.d for r in sorted(rows, key=lambda r: r.i)], [None if s is None else unicodedata.normalize("NFKD", s) for s in strings]


def test_every_assigned_character(spark):
    every = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and unicodedata.category(chr(i)) not in ("Cn", "Co")]
    got, want = both(spark, ["".join("a" + c for c in every[i : i + 500]) for i in range(0, len(every), 500)])
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_sequences_of_marks(spark, seed):
    r = random.Random(seed)
    marks = [chr(i) for i in range(sys.maxunicode + 1) if unicodedata.combining(chr(i))]
    pool = marks + ["a", "é", "한", "ﬁ", "ǆ", "\U0001d15e", "ẛ̣", " ", "Å", "ﷺ", "각"] * 30
    got, want = both(spark, ["".join(r.choices(pool, k=r.randint(0, 60))) for _ in range(300)] + [None, "", "ascii only", "́" * 500 + "̣" * 500])
    assert got == want
