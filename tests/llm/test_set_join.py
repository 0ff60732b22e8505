import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import folio.llm.set_join as J
from folio.llm.set_join import Bitmaps, WordHashes, jaccard_components, least_overlap, may_link, most_different, parity, prefix_length, shingle_set, similar


def plain_set(text, k=4):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(rows, k=4, similarity=85):
    sets = [plain_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= similarity * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        way, at = r.random(), r.randrange(len(words))
        if way < 0.5:
            words[at] = f"e{r.randrange(10**6)}"
        elif way < 0.75:
            words.insert(at, f"e{r.randrange(10**6)}")
        elif len(words) > 1:
            del words[at]
    return words


def corpus(seed, families=14, members=7):
    """Families of edited texts from a few to hundreds of words, some around the limit, with a passage that many share."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(25)]
    texts = [None, "", " \t", "one", "One two", "one two three", "one two three", "a b c d", "A b c d e"]
    for f in range(families):
        size = r.choice([5, 8, 9, 10, 14, 30, 60, 90, 250, 700])
        base = [f"f{f}w{r.randrange(size * 3)}" for _ in range(size)]
        if r.random() < 0.5:
            base[size // 2 : size // 2] = passage
        for _ in range(members):
            base = edited(r, base, r.randint(0, max(1, len(base) // 40)))
            texts += [" ".join(base)] * r.choice([1, 1, 2])
    big = [f"b{i}" for i in range(120)]  # one large group of near copies
    texts += [" ".join(edited(r, big, r.randint(0, 4))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one two three four five six"), (None, texts[-1]), (None, "alone in the world of words"), (5, texts[-2])]
    r.shuffle(rows)
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,small,hot,light", [(1, 8, 1024, None), (2, 2, 10, None), (3, 3, 16, 0), (4, 2, 1024, 10), (5, 8, 12, 63)])
def test_components_equal_all_pairs(spark, docs_of, monkeypatch, seed, small, hot, light):
    monkeypatch.setattr(J, "SMALL", small)
    monkeypatch.setattr(J, "HOT", hot)
    if light is not None:
        monkeypatch.setattr(J, "boundary", lambda *_: light)
    rows = corpus(seed)
    docs = docs_of(rows).withColumns({c: F.lit("x") for c in ("num", "n", "sid", "id", "th", "map", "component_id", "parts")})
    got = jaccard_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert result(got) == plain(rows)


def test_other_shingle_and_similarity(docs_of):
    rows = corpus(9, 8, 5)
    assert result(jaccard_components(docs_of(rows), shingle=2, similarity=70)) == plain(rows, 2, 70)


def test_empty_and_wordless_tables(docs_of):
    assert jaccard_components(docs_of([])).collect() == []
    assert result(jaccard_components(docs_of([(1, None), (2, ""), (None, " ")]))) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]


def test_boundary_falls_where_lists_are_long(spark):
    schema = "num bigint, n bigint, prefix array<bigint>"
    rare = spark.createDataFrame([(i, 20, list(range(5 * i, 5 * i + 5))) for i in range(50)], schema)
    often = spark.createDataFrame([(i, 20, list(range(5))) for i in range(50)], schema)
    assert J.boundary(rare, 85) < 4 <= J.boundary(often, 85)


@pytest.mark.parametrize("text", [None, "", "One", "a b\tC d", "x " * 70000, "é É ß " * 9])
def test_set_size(text):
    assert len(shingle_set(text, WordHashes())) == len(plain_set(text))


@pytest.mark.parametrize("seed", range(30))
def test_bounds_hold(seed):
    """No linked pair is lost by the overlap, the prefix or the bitmap bound."""
    r = np.random.default_rng(seed)
    whole = np.unique(r.integers(0, 2**64, int(r.integers(2, 2500)), np.uint64))
    other = np.unique(np.concatenate([r.choice(whole, max(1, int(len(whole) * r.uniform(0.8, 1))), replace=False), r.integers(0, 2**64, int(len(whole) * r.uniform(0, 0.12)), np.uint64)]))
    both, one_only = len(np.intersect1d(whole, other)), len(np.setxor1d(whole, other))
    linked = 100 * both >= 85 * (len(whole) + len(other) - both)
    assert similar(whole, other) == linked == similar(other, whole)
    maps = Bitmaps(np.array([len(whole), len(other)]), [parity(whole), parity(other)], 85)
    assert (maps.distances(0, np.array([1]))[0] >= 0) == (may_link(len(whole), len(other), parity(whole), parity(other)) and 100 * min(len(whole), len(other)) >= 85 * max(len(whole), len(other)))
    if linked:
        assert both >= max(least_overlap(len(whole)), least_overlap(len(other)))
        assert one_only <= most_different(len(whole), len(other))
        assert may_link(len(whole), len(other), parity(whole), parity(other))
        for k in (0, 1):
            a, b = (set(s[: prefix_length(len(s)) + k].tolist()) for s in (whole, other))
            assert len(a & b) > k or both <= k
