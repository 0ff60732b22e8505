"""Nearest neighbours by largest inner product over sharded HNSW graphs.

Distinct vectors are dealt to shards of bounded size by hash.  A shard's
index is a hierarchical navigable small-world graph: every vector is on level
0 and a geometrically falling share on each level above.  Vectors are inserted
in batches: a vector searches the graph built so far from the top level down,
greedily above its own levels and with a beam of ``EF_BUILD`` on them, and
links on each to diverse near nodes among those found and those of its batch
(a candidate is kept if it is nearer to the node than to the links kept so
far); linked nodes link back to the nearest of those that chose them.  Links
are flat int32 arrays, one row of fixed width per node.  To make inner product
a distance within the graph, each vector gets a component that brings all of
the shard's vectors to one length.

A search walks down the levels the same way and keeps a beam of ``EF`` on level
0, started also at one node of each part that links do not reach.  A shard's
index meets all queries once, in one task: it comes first in the task's rows,
and the queries stream past it in batches.  The shards' best are merged, with
scores computed in double precision on the original vectors.

Copies of a vector are one node with its smallest ids (``keep``, more than a
result can show), so a group of copies of any size is one row.

Work and rows grow with queries times shards: every shard is asked.

Defined cases: vectors that are null, empty, all zero or hold a null or
non-finite component take no part, nor do null ids; only vectors of the
query's length are candidates; repeated rows count once; ties go to the
smaller id; with fewer candidates than ``k`` all are found; a ``k`` that needs
more ids of equal vectors than the index keeps is an error; extra columns are
dropped.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SHARD = 16384  # expected vectors of a shard
LINKS, EF, EF_BUILD, STEP = 32, 96, 96, 4
BATCH = 256  # vectors inserted, or queries searched, side by side
INDEX = "dim int, shard bigint, keep int, wide boolean, vectors binary, ids array<array<bigint>>, nodes array<binary>, links array<binary>, entries array<int>"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, vector`` of the rows that take part; float vectors stay as they are, others become double."""
    v = F.col(vector_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    part = F.col(id_col).isNotNull() & v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0)
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    return vectors.filter(part).select(F.col(id_col).cast("long").alias("id"), v.cast(kind).alias("vector"))


def beam(x: np.ndarray, rows: np.ndarray, queries: np.ndarray, starts: np.ndarray, ef: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Beam searches side by side on one level.

    ``x``: the level's vectors, ``rows``: their links, ``starts``: places to
    start from, a row per query (-1: none).  Returns (places, similarities),
    ``ef`` a query, best first; -1 and -inf where fewer were reached.  Each round
    opens the ``step`` best nodes of every beam that are not open yet."""
    q = len(queries)
    seen = np.zeros((q, len(x) + 1), bool)  # the last column takes what is no node
    places = np.full((q, ef), -1, np.int64)
    sims = np.full((q, ef), -np.inf, np.float32)
    opened = np.zeros((q, ef), bool)

    def take(who: np.ndarray, new: np.ndarray) -> None:
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[who[:, None], new]] = -1
        seen[who[:, None], new] = True
        seen[:, -1] = False
        near = np.einsum("akd,ad->ak", x[new], queries[who], optimize=False)
        near[new < 0] = -np.inf
        all_sims = np.concatenate([sims[who], near], axis=1)
        best = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef] if all_sims.shape[1] > ef else np.broadcast_to(np.arange(all_sims.shape[1]), all_sims.shape)
        sims[who] = np.take_along_axis(all_sims, best, 1)
        places[who] = np.take_along_axis(np.concatenate([places[who], new], axis=1), best, 1)
        opened[who] = np.take_along_axis(np.concatenate([opened[who], np.zeros(new.shape, bool)], axis=1), best, 1)

    who = np.arange(q)
    for a in range(0, starts.shape[1], 64):  # many starts a few at a time
        take(who, starts[:, a : a + 64].copy())
    while True:
        waiting = np.where(opened[who] | (places[who] < 0), -np.inf, sims[who])
        who, waiting = who[going := np.isfinite(waiting).any(axis=1)], waiting[going]
        if not len(who):
            break
        n = min(step, ef)
        best = np.argpartition(-waiting, n - 1, axis=1)[:, :n]
        ok = np.isfinite(np.take_along_axis(waiting, best, 1))
        at = np.where(ok, np.take_along_axis(places[who], best, 1), -1)
        now = opened[who]
        np.put_along_axis(now, best, np.take_along_axis(now, best, 1) | ok, 1)
        opened[who] = now
        new = np.where(at[:, :, None] >= 0, rows[at], -1).reshape(len(who), -1).astype(np.int64)
        take(who, new)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(places, order, 1), np.take_along_axis(sims, order, 1)


def diverse(x: np.ndarray, node: int, near: np.ndarray, sims: np.ndarray, count: int) -> list[int]:
    """Places within ``near`` (best first) of the links a node keeps: those nearer to it than to a link kept before,
    then the nearest others."""
    around = x[near]
    between = around @ around.T
    closest = np.full(len(near), -np.inf, np.float32)
    kept, spare = [], []
    for c in range(len(near)):
        if len(kept) == count:
            break
        if sims[c] > closest[c]:
            kept.append(c)
            np.maximum(closest, between[c], out=closest)
        else:
            spare.append(c)
    return kept + spare[: count - len(kept)]


class Level:
    """One level while it is built: its nodes so far, their links (own ones first) and the similarities of the incoming ones."""

    def __init__(self, x: np.ndarray, nodes: np.ndarray, width: int):
        self.nodes, self.x, self.half = nodes, x[nodes], max(1, width // 2)
        self.links = np.full((len(nodes), width), -1, np.int32)
        self.back = np.full((len(nodes), width - self.half), -np.inf, np.float32)
        self.place = np.full(len(x), -1, np.int64)
        self.place[nodes] = np.arange(len(nodes))

    def insert(self, new: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
        """Link the places ``new`` to the nodes found and to each other."""
        among = self.x[new] @ self.x[new].T
        np.fill_diagonal(among, -np.inf)
        near = np.concatenate([found, np.broadcast_to(new, (len(new), len(new)))], axis=1)
        sims = np.concatenate([sims, among], axis=1)
        sources, targets, strengths = [], [], []
        for i, node in enumerate(new.tolist()):
            best = np.argsort(-sims[i], kind="stable")[:EF_BUILD]
            best = best[np.isfinite(sims[i][best])]
            kept = best[diverse(self.x, node, near[i][best], sims[i][best], self.half)] if len(best) else best
            self.links[node, : len(kept)] = near[i][kept]
            sources.append(np.full(len(kept), node))
            targets.append(near[i][kept])
            strengths.append(sims[i][kept])
        source, target, strength = (np.concatenate(a) for a in (sources, targets, strengths))
        order = np.lexsort((-strength, target))
        source, target, strength = source[order], target[order], strength[order]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, int)
        rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        room = self.back.shape[1]
        source, target, strength, rank = (a[rank < room] for a in (source, target, strength, rank))
        nodes, at = np.unique(target, return_inverse=True)
        more = np.full((len(nodes), room), -1, np.int64)
        more_sims = np.full((len(nodes), room), -np.inf, np.float32)
        more[at, rank], more_sims[at, rank] = source, strength
        all_sims = np.concatenate([self.back[nodes], more_sims], axis=1)
        all_links = np.concatenate([self.links[nodes, self.half :], more], axis=1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :room]
        self.back[nodes] = np.take_along_axis(all_sims, best, 1)
        self.links[nodes, self.half :] = np.take_along_axis(all_links, best, 1)


def _entries(links: np.ndarray, first: int) -> list[int]:
    """Nodes from which links reach every node, ``first`` among them."""
    seen, out = np.zeros(len(links), bool), []
    at = first
    while True:
        out.append(at)
        seen[at] = True
        front = np.array([at])
        while len(front):
            reached = np.unique(links[front])
            front = reached[(reached >= 0) & ~seen[reached]]
            seen[front] = True
        if seen.all():
            return out
        at = int(np.argmin(seen))


class Graph:
    """The search side of one shard."""

    def __init__(self, vectors: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray], entries: list[int]):
        self.x, self.links, self.entries, self.nodes = lifted(vectors), links, entries, nodes
        self.place = []
        for ns in nodes:
            place = np.full(len(self.x), -1, np.int64)
            place[ns] = np.arange(len(ns))
            self.place.append(place)

    def search_many(self, queries: np.ndarray, k: int, ef: int) -> list[list[int]]:
        """The ``k`` nearest nodes found of each query."""
        q = queries.astype(np.float64)
        q = np.hstack([q / np.abs(q).max(axis=1, keepdims=True), np.zeros((len(q), 1))]).astype(np.float32)
        at = np.full(len(q), self.entries[0])
        for level in range(len(self.nodes) - 1, 0, -1):
            found, _ = beam(self.x[self.nodes[level]], self.links[level], q, self.place[level][at][:, None], 1, 1)
            at = self.nodes[level][found[:, 0]]
        starts = np.concatenate([at[:, None], np.broadcast_to(self.entries, (len(q), len(self.entries)))], axis=1)
        found, _ = beam(self.x, self.links[0], q, starts.astype(np.int64), ef)
        return [[int(v) for v in row[:k] if v >= 0] for row in found]

    def search(self, query: np.ndarray, k: int, ef: int) -> list[int]:
        return self.search_many(query[None, :], k, ef)[0]


def lifted(vectors: np.ndarray) -> np.ndarray:
    """The vectors scaled to length 1 at most, with a component that makes it 1."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max()
    x /= np.sqrt((x * x).sum(1).max())
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]]).astype(np.float32)


def build_graph(vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    """(nodes by level, links by level as positions within the level, entry nodes)."""
    x, n = lifted(vectors), len(vectors)
    draws = np.random.default_rng(n).random(n)
    height = np.minimum((-np.log(np.maximum(draws, 1e-12)) / math.log(LINKS)).astype(int), 16)
    top = int(height.max())
    levels = [Level(x, np.flatnonzero(height >= k), 2 * LINKS if k == 0 else LINKS) for k in range(top + 1)]
    # the first node of the top level comes first, so that every search has a way in; batches grow with the graph
    entry = int(np.argmax(height))
    order = np.concatenate([[entry], np.delete(np.arange(n), entry)])
    done = 1
    while done < n:
        batch = order[done : done + min(BATCH, done)]
        at = np.full(len(batch), entry)
        for k in range(top, -1, -1):
            level = levels[k]
            here = height[batch] >= k
            starts = level.place[at][:, None]
            if here.any():
                found, sims = beam(level.x, level.links, x[batch[here]], starts[here], EF_BUILD)
                at[here] = level.nodes[found[:, 0]]
            if not here.all():
                far, _ = beam(level.x, level.links, x[batch[~here]], starts[~here], 1, 1)
                at[~here] = level.nodes[far[:, 0]]
            if here.any():
                level.insert(level.place[batch[here]], found, sims)
        done += len(batch)
    nodes = [level.nodes.astype(np.int32) for level in levels]
    return nodes, [level.links for level in levels], _entries(levels[0].links, entry)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: int = 21, shard: int = SHARD) -> DataFrame:
    """One row per shard (columns of ``INDEX``), written to the shared folder.

    ``keep``: how many ids of equal vectors are stored, the smallest.
    """
    rows = usable(vectors, id_col, vector_col).distinct()
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).filter(F.col("rank") <= keep)
    distinct = materialise(ranked.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    shards = max(1, -(-distinct.count() // shard))
    wide = "double" in rows.schema["vector"].dataType.simpleString()

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("first")
        dim = t.column("dim")[0].as_py()
        x = t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        nodes, links, entries = build_graph(x)
        row = [[dim], [t.column("shard")[0].as_py()], [keep], [wide], [x.tobytes()], [t.column("ids").to_pylist()], [[a.tobytes() for a in nodes]], [[a.tobytes() for a in links]], [entries]]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int32())]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["dim", "shard", "keep", "wide", "vectors", "ids", "nodes", "links", "entries"])

    dealt = distinct.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"), F.col("ids")[0].alias("first"), "vector", "ids")
    return materialise(dealt.groupBy("dim", "shard").applyInArrow(build, INDEX), "hnsw")


def search(index: DataFrame, queries: DataFrame, k: int = 20, ef: int = EF, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, its own id left out."""
    rows = usable(queries, id_col, vector_col).distinct().withColumn("dim", F.size("vector"))
    keep = index.agg(F.min("keep")).first()[0]
    if keep is not None and k + 1 > keep:
        raise ValueError(f"the index keeps {keep} ids of equal vectors; {k} neighbours need {k + 1}")
    shards = index.select("dim", "shard")
    asked = rows.join(shards, "dim").select("dim", "shard", F.lit(1).alias("kind"), "id", "vector")
    graphs = index.withColumn("kind", F.lit(0))
    both = graphs.unionByName(asked, allowMissingColumns=True)
    columns = ["kind", "dim", "wide", "vectors", "ids", "nodes", "links", "entries", "id", "vector"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, x, ids = None, None, []
        held: list[tuple[int, list[float]]] = []

        def found() -> pa.RecordBatch:
            q = np.array([v for _, v in held], np.float64)
            out: list[tuple[int, int, float]] = []
            for (query, _), vector, hits in zip(held, q, graph.search_many(q, k + 1, max(ef, k + 1))):
                scores = (x[hits].astype(np.float64) * vector).sum(1).tolist()
                best = heapq.nsmallest(k, [(-s, i) for s, v in zip(scores, hits) for i in ids[v] if i != query])
                out += [(query, i, -s) for s, i in best]
            held.clear()
            columns = list(zip(*out)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

        for batch in batches:
            kinds = batch.column(0).to_numpy()
            for i in range(batch.num_rows):
                if kinds[i]:
                    held.append((batch.column(8)[i].as_py(), batch.column(9)[i].as_py()))
                    if len(held) == BATCH:
                        yield found()
                    continue
                if held:
                    yield found()
                g = {c: batch.column(j)[i].as_py() for j, c in enumerate(columns[:8])}
                x = np.frombuffer(g["vectors"], np.float64 if g["wide"] else np.float32).reshape(-1, g["dim"])
                nodes = [np.frombuffer(b, np.int32) for b in g["nodes"]]
                links = [np.frombuffer(b, np.int32).reshape(len(ns), -1) for b, ns in zip(g["links"], nodes)]
                graph, ids = Graph(x, nodes, links, g["entries"]), g["ids"]
                del g
        if held:
            yield found()

    keys = ["dim", "shard"]
    found = both.repartition(*keys).sortWithinPartitions(*keys, "kind").select(*columns).mapInArrow(look, "query_id bigint, vec_id bigint, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
