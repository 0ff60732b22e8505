import random

import numpy as np
import pytest

from folio.llm.toxicity import OrdinalModel, drop_toxic, fit, fit_ordinal, grade_texts, select_words, text_words

BAD = ["nasty", "awful", "hateful", "vilest", "grottyer", "grottyest"]


def make(n=600, seed=3):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choices(["an", "the", "or", "is", "to", "ba", "mi"], k=r.randint(1, 3))) for _ in range(r.randint(5, 60))]
        k = r.choice([0, 0, 1, 2, 4])
        for w in r.sample(BAD, k):
            words.insert(r.randrange(len(words)), w + r.choice(["", ".", "!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(k > 0), k))
    return rows, labels


def test_learned_grades(spark, docs_of):
    rows, labels = make()
    table = spark.createDataFrame([(i, t) for i, t, _ in labels[:400]] + [(3, None), (99999, 1)], "doc_id long, toxic int")
    model = fit(docs_of(rows), table)
    got = {r.doc_id: r for r in grade_texts(docs_of(rows[400:]), model).collect()}
    truth = {i: (bool(t), k) for i, t, k in labels[400:]}
    assert sum(got[i].toxic == t for i, (t, _) in truth.items()) / len(truth) >= 0.97
    mean = lambda k: np.mean([got[i].severity for i, (_, x) in truth.items() if x == k])
    assert mean(0) < 0.2 < mean(1) < mean(2) < mean(4)
    assert all(r.toxic == (r.p_toxic >= 0.5) == (r.grade > 0) for r in got.values())
    kept = drop_toxic(docs_of(rows[400:]), model)
    assert kept.columns == docs_of([]).columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}


def test_defined_cases(spark, docs_of):
    rows, labels = make(200)
    model = fit(docs_of(rows), spark.createDataFrame([(i, t) for i, t, _ in labels], "doc_id long, toxic int"))
    odd = [(1, None), (2, ""), (3, "the " * 50_000 + "nasty awful hateful"), (4, "to an"), (4, "to an"), (None, "is")]
    got = grade_texts(docs_of(odd), model).collect()
    assert len(got) == 6 and {r.doc_id for r in got if r.toxic} == {3}
    assert grade_texts(docs_of([]), model).count() == 0


@pytest.mark.parametrize("labels,grade", [([], 0), ([(1, 0), (2, 0)], 0), ([(1, 1)], 1)])
def test_one_grade_only(spark, docs_of, labels, grade):
    model = fit(docs_of([(1, "a b"), (2, "c")]), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {(r.grade, r.severity, r.toxic) for r in grade_texts(docs_of([(5, "a"), (6, None)]), model).collect()} == {(grade, float(grade), grade > 0)}


def test_given_grades(spark, docs_of):
    rows, labels = make(400)
    model = fit(docs_of(rows), spark.createDataFrame([(i, k) for i, _, k in labels], "doc_id long, toxic int"), graded=True)
    assert len(model.thresholds) == 4 and model.thresholds == sorted(model.thresholds)


def test_fit_is_the_likelihoods_maximum():
    r = np.random.default_rng(1)
    rows = [[int(i) for i in np.flatnonzero(r.random(3) < 0.5)] for _ in range(400)]
    x = np.array([sum((1.5, -1.0, 0.5)[i] for i in row) for row in rows])
    grades = (x + r.logistic(size=400) > 0).astype(int) + (x + r.logistic(size=400) > 2).astype(int)
    w, t = fit_ordinal(rows, grades, np.ones(400), 3)

    def loss(w, t):
        m = OrdinalModel(["a", "b", "c"], w, t)
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        s = np.array([sum(w[i] for i in row) for row in rows])
        cdf = 1 / (1 + np.exp(-(edges[None] - s[:, None])))
        assert len(m.thresholds) == 2
        return -np.log(cdf[np.arange(400), grades + 1] - cdf[np.arange(400), grades]).mean()

    here = loss(w, t)
    for _ in range(60):
        assert loss(w + r.normal(0, 0.05, 3), np.sort(t + r.normal(0, 0.05, 2))) >= here - 1e-6


def test_words_and_selection():
    assert text_words("Hello, «WORLD» nasty!") == {"hello", "hell*", "world", "worl*", "nasty", "nast*"}
    texts = [text_words("bad bits")] * 30 + [text_words("good bits")] * 30
    assert select_words(texts, np.array([True] * 30 + [False] * 30)) == ["bad"]


def test_a_repeated_id_pushes_nothing_out(spark, docs_of):
    rows, labels = make(300)
    hot = [(1, rows[1][1])] * 10_000
    table = spark.createDataFrame([(i, t) for i, t, _ in labels], "doc_id long, toxic int")
    right = []
    for more in ([], hot):
        got = {r.doc_id: r.toxic for r in grade_texts(docs_of(rows), fit(docs_of(rows + more), table, per_class=60)).collect()}
        right.append(sum(got[i] == bool(t) for i, t, _ in labels) / len(labels))
    assert right[1] >= right[0] - 0.01 and right[0] >= 0.9
