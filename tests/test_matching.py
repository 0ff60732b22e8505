"""Matching: candidates, best match (pruned == brute force), authority
reconciliation, suggestions and the blocked fuzzy join (== brute force)."""

import random
import unicodedata

import pytest

from pyspark.sql import functions as F

from folio.functions import blocks
from folio.operators import matching as M


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def lev_score_py(a, b):
    if a is None or b is None:
        return 0
    m = max(len(a), len(b))
    if m == 0:
        return 100
    return (200 * (m - lev(a, b)) + m) // (2 * m)


def test_reference_index_sets():
    s = M.reference_index_sets()
    assert len(s) == 94 and len(set(s)) == 83
    assert s[:12] == [(0,), (1,), (2,), (3,), (0, 1), (0, 1, 2), (1, 2), (2, 3), (1, 2, 3), (3, 4), (0, 2), (1, 3)]
    assert s[-5:] == [(0, 3), (1, 0), (2, 1), (3, 2), (4, 3)]
    assert (2, 3, 4) not in s and (26,) not in s and (27,) not in s
    assert max(max(x) for x in s) == 27


def test_ratio_golden():
    assert blocks.ratio("abcd", "abcx") == 75
    assert blocks.ratio("cold widget", "cold widgit") == 91
    a = "a" * 50 + "b" * 50
    assert blocks.ratio(a, a[:50] + "x" + a[50:]) == 100  # 100 although different
    b = "a" * 50 + "b" * 49
    assert blocks.ratio(b, b[:50] + "x" + b[50:]) == 99
    assert blocks.ratio(None, "x") == 0 and blocks.ratio("", "") == 100 and blocks.ratio("", "x") == 0


def _docs(n_docs=40, seed=7):
    rnd = random.Random(seed)
    words = ["the", "of", "a", "growth", "corn", "fuel", "study", "x", "", "long" * 5, "Corn", "FUEL", "É", "1999"]
    docs = []
    for i in range(n_docs):
        n = rnd.choice([0, 3, 4, 10, 28, 30])
        lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6))) for _ in range(n)]
        kw = lines[0] if lines and rnd.random() < 0.5 else " ".join(rnd.choice(words) for _ in range(3))
        if rnd.random() < 0.3 and kw is not None:
            kw = kw.upper()  # case-mismatched keyword: exercises the class-count bound
        if rnd.random() < 0.1:
            kw = None
        docs.append((i + 1000 * seed, lines, kw))
    return docs


def _brute(lines, kw, min_lines, score):
    if len(lines) < min_lines:
        return None
    best = None
    for o, ix in M.distinct_index_sets():
        if max(ix) >= len(lines):
            continue
        t = " ".join(lines[j] for j in ix)
        s = score(kw, t)
        if best is None or s > best[0]:
            best = (s, o, t)
    return best


def test_best_line_native_equals_brute_force(spark):
    docs = _docs() + _docs(60, seed=5)
    df = spark.createDataFrame(docs, "id int, lines array<string>, kw string")
    for min_lines in (28, 4):
        got = {r["id"]: r["b"] for r in df.select("id", M.best_line_native(F.col("lines"), F.col("kw"), min_lines).alias("b")).collect()}
        for i, lines, kw in docs:
            exp = _brute(lines, kw, min_lines, lev_score_py)
            g = got[i]
            if exp is None:
                assert g is None
            else:
                assert (g["score"], g["ord"], g["text"]) == (exp[0], exp[1], exp[2].strip()), (i, kw)


def test_best_line_ratio_equals_brute_force(spark):
    docs = _docs(seed=11)
    df = spark.createDataFrame(docs, "id int, lines array<string>, kw string")
    for least in (4, 28):
        out = {r["id"]: r["b"] for r in df.select("id", M.best_line_ratio(F.col("lines"), F.col("kw"), least).alias("b")).collect()}
        for i, lines, kw in docs:
            exp = _brute(lines, kw, least, blocks.ratio)
            got = out[i]
            assert (got["score"], got["ord"]) == (exp[:2] if exp else (None, None))
            assert got["text"] == (unicodedata.normalize("NFKD", exp[2]).strip() if exp else None)


def _authority(spark):
    names = ["Agronomy", "Food Science", "Food-Science", "Physics", "Apparel, Merchandising, and Design", "Physics"]
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "authority_name string, ord long")


def test_reconcile(spark):
    vals = spark.createDataFrame(
        [("AGRONOMY",), ("food science",), ("Physics; Agronomy",), ("Physics; Nope",), ("Nope",), ("",), ("apparel merchandising and design",)], "major string"
    )
    got = {r["major"]: (r["resolved"], r["status"]) for r in M.reconcile(vals, "major", _authority(spark)).collect()}
    assert got["AGRONOMY"] == ("Agronomy", "exact")
    assert got["food science"] == ("Food Science", "exact")  # earliest spelling wins
    assert got["Physics; Agronomy"] == ("Physics; Agronomy", "pair")
    assert got["Physics; Nope"] == (None, "review")
    assert got["Nope"] == (None, "review") and got[""] == (None, "review")
    assert got["apparel merchandising and design"] == (None, "review")  # punctuation leaves double blanks


def test_suggestions_top3_ties_to_earlier(spark):
    vals = spark.createDataFrame([("Physic",)], "major string")
    rows = M.suggestions(vals, "major", _authority(spark), k=3).orderBy("rank").collect()
    assert [r["suggestion"] for r in rows][0] == "Physics"
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    top = lambda v: [(r["suggestion"], r["score"]) for r in M.suggestions(spark.createDataFrame([(v,)], "major string"), "major", _authority(spark), k=3).orderBy("rank").collect()]
    assert top("Science Food")[0] == ("Food Science", 95)  # word order
    assert top("Agronomy and Soils")[0] == ("Agronomy", 90)  # a part
    none = spark.createDataFrame([("qqq",), ("",), (None,), ("?!",)], "major string")
    assert M.suggestions(none, "major", _authority(spark), k=3).count() == 0  # no character in common
    empty = spark.createDataFrame([], "authority_name string, ord long")
    assert M.suggestions(vals, "major", empty, k=3).count() == 0


@pytest.mark.parametrize("list_block,value_block", [(1 << 16, 1 << 12), (40, 7)])
def test_suggestions_equal_scoring_every_entry(spark, monkeypatch, list_block, value_block):
    monkeypatch.setattr(M, "LIST_BLOCK", list_block)
    monkeypatch.setattr(M, "VALUE_BLOCK", value_block)
    rnd = random.Random(5)
    words = ["growth", "corn", "fuel", "study", "of", "soils", "agronomy", "food", "science", "physics", "engineering", "a"]
    vowels = str.maketrans("aeiou", "eioua")
    for size in (30, 300):  # the list grows
        names = list(dict.fromkeys(" ".join(rnd.choices(words, k=rnd.randint(1, 5))) for _ in range(size)))
        values = [" ".join(rnd.choices(words, k=rnd.randint(1, 5))).translate(vowels) for _ in range(30)] + ["corn", "soils agronomy", "zzz", "of a study of corn fuel growth and more", "q" * 20000, "of " * 6000]
        authority = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "authority_name string, ord long")
        got = {(r["value"], r["rank"]): (r["suggestion"], r["score"]) for r in M.suggestions(spark.createDataFrame([(v,) for v in values], "major string"), "major", authority).collect()}
        exp = {}
        for v in set(values):
            best = sorted((-blocks.weighted(v, x), i) for i, x in enumerate(names) if blocks.weighted(v, x) > 0)[:3]
            exp |= {(v, k): (names[i], -score) for k, (score, i) in enumerate(best, 1)}
        assert got == exp


def test_fuzzy_join_equals_brute_force(spark):
    rnd = random.Random(3)
    alpha = "abcde "
    left = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 45))) for _ in range(60)]

    def misspelt(s):
        s = list(s)
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(s) + 1)
            s[i : i + rnd.randint(0, 1)] = rnd.choice(["", "x", "a"])
        return "".join(s)

    right = [misspelt(s) for s in left * 3] + [None, ""] + ["ab" * 10] * 40 + ["ab" * 10 + "a"] * 20  # hot strings of few grams
    left += ["ab" * 10, "ab" * 11, None, "Of", "Of"]
    right += ["Of", "On"]
    L = spark.createDataFrame(list(enumerate(left)), "lid int, s string")
    R = spark.createDataFrame(list(enumerate(right)), "rid int, r string")
    for rate, chars in ((0.1, 1), (0.15, 5), (0.0, 0)):
        got = [(r["lid"], r["rid"], r["dist"]) for r in M.fuzzy_join(L, "lid", "s", R, "rid", "r", rate, chars).collect()]
        exp = {(i, j, lev(a, b)) for i, a in enumerate(left) for j, b in enumerate(right)
               if a is not None and b is not None and min(len(a), len(b)) >= chars and lev(a, b) <= int(rate * max(len(a), len(b)) + 1e-9)}
        assert len(got) == len(set(got)) and set(got) == exp
