"""Embargo decision tree."""

import pytest
from pyspark.sql import functions as F

from folio.functions import dates

RS = "array<struct<_VALUE:string,_code:string,_remove:string>>"


def emb(spark, acc, rs, opt, dec, rel):
    df = spark.createDataFrame([(acc, rs, opt, dec, rel)], f"a string, rs {RS}, o string, d string, r string")
    e = dates.embargo_date(F.col("a"), F.col("rs"), F.col("o"), F.col("d"), F.col("r"))
    row = df.select(e.alias("e")).collect()[0]["e"]
    return row["value"], row["error"]


@pytest.mark.parametrize(
    "args,expected",
    [
        (("0", [("", "1", "1/2/2020")], "", "", ""), "2020-01-02"),
        (("0", [("", "1", "")], "", "", ""), "--"),
        (("0", [("0", "1", "1/2/2020")], "", "", ""), "2001-01-01"),
        (("0", [("1", None, "1/2/2020")], "", "", ""), "2001-01-01"),
        (("0", [], "", "", ""), "2001-01-01"),
        (("1", [], "No, 6 month delayed release", "2015-09-25 13:20:00", ""), "2016-03-23"),
        (("1", [], "No, 1 year delayed release", "2015-09-25 13:20:00", ""), "2016-09-24"),
        (("1", [], "No, 2 year delayed release", "2015-09-25 13:20:00", ""), "2017-09-24"),
        (("1", [], "Yes", "2015-09-25 13:20:00", ""), "2001-01-01"),
        (("1", [], "", "", "2020-05-01T00:00"), "2020-05-01"),
        (("1", [], "", "", ""), "2001-01-01"),
        ((None, [], "", "", ""), "2001-01-01"),
    ],
)
def test_embargo(spark, args, expected):
    assert emb(spark, *args)[0] == expected


def test_embargo_bad_date_is_flagged_not_fatal(spark):
    value, error = emb(spark, "1", [], "No, 6 month delayed release", "2015-09-25", "")
    assert value is None and error == "bad decision date"
