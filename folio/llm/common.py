"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import ensure_checkpoint_dir

HOLD_OUT = 5  # folds of ``fold``


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that read the
    table, and the reread table is not computed twice.  The table stays until
    ``release``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


WRITTEN: list[str] = []  # tables of this process that were not released


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the intermediate tables written so far, from the ``since``-th on and
    but for the last ``keep``, once the results that read them are stored; returns how many."""
    gone = WRITTEN[since : len(WRITTEN) - keep]
    del WRITTEN[since : len(WRITTEN) - keep]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in gone:
        path = hadoop(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)


def fold(doc_id: Column | str, n: int = HOLD_OUT) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def per_worker(key: tuple, build: Callable):
    """An object built once per Python worker and shared by its later tasks.

    Functions shipped by value get fresh module globals with every task, so
    the objects live in a module of their own.
    """
    holder = sys.modules.get("_folio_worker_objects")
    if holder is None:
        holder = sys.modules["_folio_worker_objects"] = types.ModuleType("_folio_worker_objects")
        holder.objects = {}
    if key not in holder.objects:
        holder.objects[key] = build()
    return holder.objects[key]


class RecentCache:
    """Map of at most ``2 * size`` entries that forgets what was not used lately.

    Two generations: reads promote from the old one, and when the young one
    is full it becomes the old one.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        v = self.young.get(key)
        if v is None:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
