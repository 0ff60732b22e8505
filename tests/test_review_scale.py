"""The steps of the review queue that must not outgrow their input: exact, with less work."""

import random

import pytest
from pyspark.sql import functions as F

from folio.functions import blocks, fuzzy
from folio.operators import matching as M


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1]


def _pairs(seed, n=250):
    rnd, out = random.Random(seed), []
    for _ in range(n):
        a = "".join(rnd.choices("abcdeé𝄞 ABC", k=rnd.choice([0, 1, 2, 30, 70, 120])))
        i = rnd.randint(0, len(a))
        b = rnd.choice([a, a.upper(), a[:-1] + "#", a + "zz", a[:i] + "Q" + a[i + 1 :], a[:i] + "xy" + a[i:], a[i:], "".join(rnd.choices("abcdeé𝄞 ABC", k=rnd.choice([0, 1, 30, 90])))])
        out.append((a, b, lev(a, b), rnd.randint(0, 120)))
    return out


def test_edits_side_by_side(spark):
    rows = _pairs(1)
    df = spark.createDataFrame(rows, "a string, b string, d int, most int")
    a, b, d, most = (F.col(c) for c in ("a", "b", "d", "most"))
    got = df.select("a", "b", "d", "most", fuzzy.edits(a, b).alias("free"), fuzzy.edits(a, b, most, F.greatest(d - 1, F.lit(0))).alias("limited"),
                    M._edits(a, b, most, F.lit(0), F.lit(False), F.lit(1 << 40)).alias("later"), M._edits(a, b, most, d, F.lit(True), F.lit(1 << 40)).alias("first"))
    for r in got.collect():
        assert r.free == r.d, r
        for x in (r.limited, r.later, r.first):
            assert x == r.d or x < 0 and r.d > r.most or x > r.most and r.d > r.most, r
    null = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in null.select(fuzzy.edits(F.col("a"), F.col("b"))).collect()] == [None] * 3
    assert [r[0] for r in null.select(fuzzy.lev_score("a", "b")).collect()] == [0] * 3


def test_given_up_searches_are_settled(spark):
    """What array expressions leave open, the Arrow pass finds: the best of all candidates, the earliest of equal ones."""
    rnd, rows = random.Random(4), []
    words = ["the", "of", "a", "growth", "corn", "fuel", "study", "x", "", "Corn", "FUEL", "É", "𝄞 1999"]
    for i in range(60):
        lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6))) for _ in range(rnd.choice([0, 3, 4, 10, 30]))]
        kw = rnd.choice([None, "", lines[-1] if lines else "x", " ".join(rnd.choices(words, k=4)), (lines or ["q"])[0].translate(str.maketrans("aeiou", "eioua"))])
        rows.append((i, lines, kw, rnd.choice([None, kw, "Corn fuel"])))
    df = spark.createDataFrame(rows, "id int, lines array<string>, kw string, other string")
    found = df.select("*", *[M.best_line_native(F.col("lines"), F.col(k), 4, room=0).alias(f"b_{k}") for k in ("kw", "other")])
    assert found.filter("b_kw.open").count() > 10
    got = {r.id: r for r in M.settle_native(found, "lines", {"b_kw": "kw", "b_other": "other"}, 4).collect()}
    for i, lines, *keywords in rows:
        for kw, b in zip(keywords, (got[i].b_kw, got[i].b_other)):
            all_ = [(0 if kw is None else blocks.native_score(max(len(kw), len(t)), lev(kw, t)), -o, t.strip())
                    for o, ix in M.distinct_index_sets() if max(ix) < len(lines) and len(lines) >= 4 for t in [" ".join(lines[k] for k in ix)]]
            if not all_:
                assert b is None
            else:
                score, o, t = max(all_, key=lambda x: x[:2])
                assert (b.score, b.ord, b.text, b.open) == (score, -o, t, False), (i, kw)


def test_long_titles_need_no_table(spark):
    """A title of 300,000 characters against its own line: a table of 9e10 cells, or one look at every place."""
    rnd = random.Random(2)
    title = "".join(rnd.choices("abcdefghij", k=300_000))
    lines = ["x" * 9, title, "y z", "end"]
    df = spark.createDataFrame([(title.upper(), lines), (title[:-1] + "#", lines)], "kw string, lines array<string>")
    got = [r[0] for r in df.select(M.best_line_native(F.col("lines"), F.col("kw"), 4)).collect()]
    assert [(g["score"], g["text"] == title) for g in got] == [(0, False), (100, True)]


@pytest.mark.parametrize("seed", range(3))
def test_weighted_from_a_least_score_on(seed):
    rnd = random.Random(seed)
    words = ["growth", "and", "the", "of", "a", "corn", "fuel", "study", "ab", "éa", "x"]
    text = lambda: " ".join(rnd.choices(words, k=rnd.choice([1, 2, 3, 8, 60]))) if rnd.random() < 0.6 else "".join(rnd.choices("abc é", k=rnd.choice([1, 5, 40, 240])))
    for _ in range(300):
        a, b, least = text(), text(), rnd.randint(0, 101)
        whole, limited = blocks.weighted(a, b), blocks.weighted(a, b, least)
        assert limited == whole if whole >= least else limited < least, (a, b, least)
        short, long_ = sorted((a, b), key=len)
        assert blocks.part_ratio(a, b) <= round(100 * blocks.window_bounds(short, long_).max()) or short == long_


def test_suggestions_in_several_tasks(spark):
    """Scores take long on few bytes: their tasks are named, not put together by size."""
    names = spark.createDataFrame([(x, i) for i, x in enumerate(["Agronomy", "Physics", "Food Science"])], "authority_name string, ord long")
    values = spark.createDataFrame([(f"agronomy of field {i}",) for i in range(300)], "major string")
    got = M.suggestions(values, "major", names)
    assert got.filter("rank = 1").count() == 300
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()


def test_scores_without_room_are_settled(spark):
    rows = _pairs(7, 120) + [(None, "a", 0, 0), ("a", None, 0, 0)]
    df = spark.createDataFrame(rows, "a string, b string, d int, most int").withColumn("score", fuzzy.lev_score("a", "b", 0))
    assert df.filter("score IS NULL").count() > 20
    for r in M.settle_scores(df, "score", F.col("a"), F.col("b")).collect():
        assert r.score == (0 if r.a is None or r.b is None else blocks.native_score(max(len(r.a), len(r.b)), r.d)), r
