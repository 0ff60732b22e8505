"""Dense row numbers and ordered batches without a single-partition window.

Rows are dealt by range of the order and sorted within their partition; the
result is written, which fixes each row's partition and place.  The rows of
each partition are counted, and a partition's offset is the sum of the counts
before it: one number a partition goes through the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

PLACE_BITS = 33  # a row's place within its partition, in Spark's increasing ids


def with_row_index(df: DataFrame, order: list[Column | str], name: str = "index") -> DataFrame:
    """Adds ``name``: 0 to n - 1 in the order of ``order`` (nulls first).

    Rows that are equal in ``order`` are numbered in some order, the same for
    all uses of the result.  The rows lie in that order, partition by
    partition.  A key that many rows share is not split: add columns that part
    its rows (equal rows are interchangeable).  An empty table stays empty."""
    place, part = f"__{name}_place", f"__{name}_part"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    fixed = written(ranged, "indexed")
    number = F.shiftright(F.col(place), PLACE_BITS)
    counts = dict(fixed.groupBy(number.alias("p")).count().collect())
    parts = sorted(counts)
    starts = dict(zip(parts, accumulate((counts[p] for p in parts), initial=0)))
    offsets = df.sparkSession.createDataFrame([(p, starts[p]) for p in parts], f"{part} long, __{name}_start long")
    joined = fixed.withColumn(part, number).join(F.broadcast(offsets), part)  # a row a partition
    dense = (F.col(f"__{name}_start") + F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).alias(name)
    return joined.select(*df.columns, dense)


def ordered_batches(df: DataFrame, order: list[Column | str], size: int, batch: str = "batch", position: str = "position") -> DataFrame:
    """Adds ``batch`` and ``position``: batches of exactly ``size`` rows in the
    order of ``order`` (the last one has the rest), positions from 0."""
    indexed = with_row_index(df, order, "__row")
    return indexed.withColumns({batch: F.floor(F.col("__row") / size).cast("long"), position: (F.col("__row") % size).cast("long")}).drop("__row")
