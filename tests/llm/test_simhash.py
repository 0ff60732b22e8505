import random

import numpy as np
import pytest
import xxhash

from folio.llm.components import component_roots
from folio.llm.simhash import chain_keys, forest, near_components, near_links, segments, simhash
import folio.llm.simhash as S


def plain_simhash(text, k=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b\tC d e a b c d e", "é É ß " * 9, "x " * 70000])
def test_fingerprint(text):
    assert simhash(text) == plain_simhash(text)


def planted(seed, n=60):
    r = random.Random(seed)
    fps = [r.getrandbits(64) for _ in range(n)]
    for f in list(fps):
        for _ in range(3):
            for b in r.sample(range(64), r.randint(1, 6)):
                f ^= 1 << b
            fps.append(f)
    return sorted({f - (1 << 64) if f >> 63 else f for f in fps})


@pytest.mark.parametrize("hot", [4096, 3])
def test_links_connect_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    fps = planted(1)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = [(r.a, r.b) for r in near_links(df).collect()]
    far = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert all(far(a, b) <= 4 for a, b in links)
    pairs = {frozenset(p) for p in links}
    assert components(fps, lambda a, b: far(a, b) <= 4) == components(fps, lambda a, b: frozenset((a, b)) in pairs)


def test_any_near_pair_shares_a_key(spark):
    r = random.Random(5)
    for bits in (1, 4):
        a = r.getrandbits(63)
        others = [a ^ sum(1 << b for b in r.sample(range(63), bits)) for _ in range(40)]
        rows = chain_keys(spark.createDataFrame([(x,) for x in {a, *others}], "fp long"), bits).collect()
        keys = {}
        for x in rows:
            keys.setdefault(x.fp, set()).add(x.key)
        assert all(keys[a] & keys[o] for o in others)


def test_forest_is_smaller_than_its_group():
    fps = np.array([1 << b for b in range(40)], np.uint64)
    ring = segments()
    masks = [[np.uint64(S._mask([ring[(s + k) % 5] for k in range(n)])) for n in range(1, 5)] for s in range(5)]
    assert len(forest(fps, masks, 4)) == 39


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(900, 950), (1000, 1000)]
    got = {r.node: r.root for r in component_roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 950: 900}


def test_documents(spark, docs_of):
    base = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf " * 6
    rows = [(1, base), (2, base), (3, base + "today"), (4, "something else entirely is written here"), (5, None), (6, ""), (7, base.upper()), (7, base.upper()), (None, "nothing of an id")]
    got = near_components(docs_of(rows)).collect()
    assert len(got) == len(rows)
    fp = {r[0]: plain_simhash(r[1]) for r in rows}
    comp = components([k for k in fp if k is not None], lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    for r in got:
        assert r.fingerprint == f"{fp[r.doc_id]:016x}"
        assert r.component_id == (None if r.doc_id is None else comp[r.doc_id])
    assert near_components(docs_of([])).count() == 0
