"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

PARTITIONS = "spark.folio.text.partitions"  # session setting


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows to ``partitions`` tasks for CPU-heavy per-row work; None
    leaves the scan's own splits (no shuffle)."""
    return df if partitions is None else df.repartition(partitions)
