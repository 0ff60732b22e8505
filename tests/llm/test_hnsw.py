import math

import numpy as np
import pytest

import folio.llm.hnsw as H
from folio.llm.hnsw import Graph, build_graph, build_index, search

ROWS = "vec_id long, embedding array<float>, label int, ids int, vector int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, 0, 0) for i, v in rows], ROWS).repartition(3)


def usable(rows):
    return list({(i, tuple(np.float32(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})


def brute(rows, queries, k):
    out = {}
    for q, v in usable(queries):
        near = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), i) for i, w in usable(rows) if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_norms_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD", 400)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)) * rng.lognormal(0, 0.7, (1500, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    queries = rows[::20]
    got, want = found(search(build_index(frame(spark, rows)), frame(spark, queries))), brute(rows, queries, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.97
    vectors = dict(usable(rows))
    for q, near in got.items():
        assert all(math.isclose(s, sum(float(a) * float(b) for a, b in zip(vectors[q], vectors[i])), rel_tol=1e-12, abs_tol=1e-12) for i, s in near)
        assert near == sorted(near, key=lambda n: (-n[1], n[0]))


def test_odd_rows_copies_and_ties(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(i, one) for i in range(60)] + [(100 + i, [0.5, float(i), 0.0]) for i in range(5)]
    rows += [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 0.0]), (204, [float("nan"), 1.0, 1.0]), (205, [float("inf"), 1.0, 1.0]), (None, one), (206, [1.0, 1.0]), (207, [2.0, 1.0]), (3, one), (3, one)]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [(206, [1.0, 1.0])]
    got = found(search(build_index(frame(spark, rows)), frame(spark, queries), k=20))
    assert got == {q: n for q, n in brute(rows, queries, 20).items() if n}
    assert [i for i, _ in got[20]] == [i for i in range(21) if i != 20]


def test_every_node_is_reached_and_few_candidates_all_found(spark):
    rng = np.random.default_rng(1)
    clusters = np.concatenate([rng.normal(c, 1e-3, (40, 4)) for c in (-9, 0.1, 7)]).astype(np.float32)
    nodes, links, entries = build_graph(clusters)
    graph = Graph(clusters, nodes, links, entries)
    assert sorted(graph.search(clusters[0], 120, 120)) == list(range(120))
    rows = [(i, clusters[i].tolist()) for i in range(0, 120, 10)]
    got = found(search(build_index(frame(spark, rows)), frame(spark, rows[:2]), k=20))
    assert {q: sorted(i for i, _ in n) for q, n in got.items()} == {0: list(range(10, 120, 10)), 10: [0, *range(20, 120, 10)]}


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 2.0])]])
def test_empty(spark, rows):
    assert search(build_index(frame(spark, rows)), frame(spark, rows)).count() == 0
    assert search(build_index(frame(spark, rows)), frame(spark, [])).count() == 0


def test_double_vectors_keep_their_precision(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 5))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found(search(build_index(df), df.filter("vec_id % 20 = 0")))
    for q, near in got.items():
        assert [i for i, _ in near] == sorted((i for i in range(90) if i != q), key=lambda i: (-float(x[q] @ x[i]), i))[:20]
        assert all(math.isclose(s, float(x[q] @ x[i]), rel_tol=1e-13, abs_tol=1e-15) for i, s in near)


def test_too_few_kept_copies_is_an_error(spark):
    df = frame(spark, [(20, [1.0, 2.0])])
    with pytest.raises(ValueError):
        search(build_index(df, keep=5), df, k=20)


def test_nodes_are_found_by_searching_what_was_built(monkeypatch):
    """The graph comes from beam searches of the graph before it: no exact neighbour table is made."""
    seen = []
    real = H.beam
    monkeypatch.setattr(H, "beam", lambda x, rows, *a: (seen.append(int((rows >= 0).any(axis=1).sum())), real(x, rows, *a))[1])
    x = np.random.default_rng(2).normal(size=(900, 12)).astype(np.float32)
    nodes, links, entries = build_graph(x)
    assert max(seen) > 600 and len(seen) >= 10
    graph = Graph(x, nodes, links, entries)
    hits = sum(len(set(graph.search(x[i], 10, 96)) & set(np.argsort(-(x @ x[i]))[:10].tolist())) for i in range(0, 900, 30))
    assert hits >= 0.97 * 300
