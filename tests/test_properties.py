"""Property tests."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.functions import dates, text
from folio.operators import rules as R


@settings(max_examples=30, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1000, 1, 1), max_value=dt.date(9999, 12, 31)), min_size=1, max_size=20))
def test_mdy_equals_date_format(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(dates.mdy_to_iso(F.date_format("d", "M/d/yyyy")).alias("a"), F.date_format("d", "yyyy-MM-dd").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


@settings(max_examples=20, deadline=None)
@given(
    st.dictionaries(st.text("abc", min_size=1, max_size=3), st.lists(st.text("xyz", max_size=3), min_size=1, max_size=4), max_size=5),
    st.lists(st.text("abc", max_size=3), max_size=8),
)
def test_one_to_many_size(spark, mapping, cats):
    df = spark.createDataFrame([(cats,)], "c array<string>")
    got = df.select(R.one_to_many_array(F.col("c"), mapping) if mapping else F.col("c")).collect()[0][0]
    assert len(got) == sum(len(mapping.get(c, [c])) for c in cats)


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet="abcXYZ -~", max_size=30))
def test_title_case_idempotent(spark, s):
    once = spark.createDataFrame([(s,)], "s string").select(text.title_case("s")).collect()[0][0]
    twice = spark.createDataFrame([(once,)], "s string").select(text.title_case("s")).collect()[0][0]
    assert once == twice
