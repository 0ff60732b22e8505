"""Connected components of an edge table, by alternating large and small stars.

Each round's edges are written to the shared folder, so a lost executor costs
a task and not the rounds before.  The minimum of a node's neighbours is
aggregated (partially on the map side) and joined back between two written
tables, where adaptive execution can split the partition of a hub.

Defined cases: repeated edges and both directions of one count once; an edge
from a node to itself, or with a null end, connects nothing; nodes without
edges are not in the result; an empty table gives an empty result; extra
columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


TASK_EDGES = 250_000  # a table of fewer is one task's work, however many partitions a shuffle has


def _few(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(max(1, -(-rows // TASK_EDGES)))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _with_least(links: DataFrame, rows: int) -> DataFrame:
    """``u, v, least``: least = the smallest of u and all its v; ``rows``: how many links there are at most."""
    least = materialise(_few(links.groupBy("u").agg(F.min("v").alias("least")), rows), "least")
    return links.join(least, "u").select("u", "v", F.least("u", "least").alias("least"))


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b of one orderable type); root: the component's smallest node."""
    pair = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialise(pair.distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both, n = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), 2 * mark[0]
        large = _with_least(both, n).filter("v > u AND v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = materialise(_few(large.distinct(), n), "large")
        starred = _with_least(large, n)
        small = starred.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).union(starred.select("u", F.col("least").alias("v")))
        now = materialise(_few(small.distinct(), n), "edges")
        seen, mark = mark, _mark(now)
        if mark == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
