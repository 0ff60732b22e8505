import zlib

import pytest
from pyspark.sql import functions as F

from folio.llm.common import RecentCache, WRITTEN, fold, materialise, per_worker, release


def test_materialised_tables_are_released(spark):
    release(spark)
    df = materialise(spark.range(5).withColumn("x", F.lit("a")), "numbers")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4]
    assert materialise(spark.range(0), "none").count() == 0
    path = WRITTEN[0]
    assert release(spark) == 2 and not WRITTEN
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_fold_is_crc32_of_the_id_as_text(spark):
    ids = [0, 7, -3, 123456789, None]
    got = {r.i: r.f for r in spark.createDataFrame([(i,) for i in ids], "i long").select("i", fold("i").alias("f")).collect()}
    assert got == {i: zlib.crc32(str("" if i is None else i).encode()) % 5 for i in ids}


def test_cache_keeps_what_was_used_lately():
    cache = RecentCache(2)
    for k in "abc":
        cache.put(k, k)
    assert cache.get("a") == "a"  # promoted from the old generation
    cache.put("d", "d")
    assert cache.get("a") == "a" and cache.get("b") is None
    assert len(cache.young) <= 2 and len(cache.old) <= 2


def test_per_worker_builds_once():
    made = []
    build = lambda: made.append(1) or object()
    assert per_worker(("test", 1), build) is per_worker(("test", 1), build) and made == [1]
