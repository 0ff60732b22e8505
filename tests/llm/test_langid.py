import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm.common import fold
from folio.llm.langid import FAMILIES, LanguageModel, family_of, fit, predict_languages, text_vector

SYLLABLES = {
    "en": "the ing tion and er wh th ou ed ly".split(), "de": "der sch ung und ein ich keit ver über zu".split(), "nl": "het een ij en van oe aan sch ver tje".split(),
    "fr": "les eau que ment tion ou è pas é un".split(), "es": "los ción que mente ñ ado una el rr ez".split(), "xx": "ka ki ku ke ko na ni nu".split(),
}


def sentence(r, lang, n=30):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n)).capitalize() + "."


def labelled(spark, n=40):
    r = random.Random(11)
    rows = [(i, sentence(r, lang), lang) for i, lang in enumerate(list(SYLLABLES) * n)]
    return spark.createDataFrame(rows + [(9001, None, "en"), (9002, "no label here", None)], "doc_id long, text string, lang string")


def test_families_share_no_language():
    members = [x for langs in FAMILIES.values() for x in langs]
    assert len(members) == len(set(members)) and family_of("de") == family_of("en") != family_of("fr") and family_of("xx") == "xx"


def test_vector_counts_the_whole_text(monkeypatch):
    import folio.llm.langid as M

    text = "Über THE 12 tion, " * 500
    whole = text_vector(text)
    monkeypatch.setattr(M, "BLOCK", 100)
    assert np.allclose(text_vector(text), whole) and np.isclose(np.linalg.norm(whole), 1)


def test_held_out_accuracy_and_defined_cases(spark, docs_of):
    docs = labelled(spark)
    model = fit(docs.filter(fold("doc_id") != 0))
    assert set(model.families) == {"germanic", "romance", "xx"} and len(model.pair_weights["germanic"]) == 3
    held = docs.filter((fold("doc_id") == 0) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    got = predict_languages(held, model).join(docs, "doc_id").collect()
    assert len(got) > 30 and sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.97
    r = random.Random(1)
    rows = [(1, None), (2, ""), (3, "123 !? ٣ ² ½ Ⅷ"), (4, sentence(r, "es", 20_000)), (4, sentence(r, "es")), (None, sentence(r, "xx"))]
    out = predict_languages(docs_of(rows), model).collect()
    assert sorted((str(x.doc_id), x.lang_pred) for x in out) == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "es"), ("4", "es"), ("None", "xx")]
    assert all(0 <= x.score <= 1 and (x.score == 0) == (x.lang_pred == "und") for x in out)
    assert predict_languages(docs_of([]), model).count() == 0


def test_pair_votes():
    r = random.Random(2)
    langs = ["de", "en", "nl"] * 20
    model = LanguageModel(np.array([text_vector(sentence(r, x)) for x in langs]), langs)
    assert [model.predict(sentence(r, x))[0] for x in ("de", "en", "nl")] == ["de", "en", "nl"]


@pytest.mark.parametrize("rows,want", [([], "und"), ([(1, "only one language", "en")], "en")])
def test_few_labels(spark, docs_of, rows, want):
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in predict_languages(docs_of([(5, "some text")]), model).collect()] == [want]


def test_a_repeated_id_pushes_no_language_out(spark):
    r = random.Random(4)
    rows = [(i, sentence(r, lang), lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 30)]
    hot = [(4, rows[4][1], "en")] * 10_000
    model = fit(spark.createDataFrame(rows + hot, "doc_id long, text string, lang string").repartition(4), per_lang=20, total=80)
    assert sorted(x for m in model.members.values() for x in m) == ["de", "en", "es", "fr"]
    assert [model.predict(sentence(r, x))[0] for x in ("en", "de", "fr", "es")] == ["en", "de", "fr", "es"]


def plain_predict(model, text):
    """The two steps by definition: the family of the greatest margin, then a vote of all pairs within it."""
    x = text_vector(text).astype(float)
    margin = lambda w: float(w[:-1].astype(float) @ x + w[-1])
    family = max(model.families, key=lambda f: margin(model.family_weights[model.families.index(f)]))
    members = model.members[family]
    votes = dict.fromkeys(members, 0)
    total = dict.fromkeys(members, 0.0)
    pairs = [(a, b) for i, a in enumerate(members) for b in members[i + 1 :]]
    for (a, b), w in zip(pairs, model.pair_weights[family]):
        m = margin(w)
        votes[a if m >= 0 else b] += 1
        total[a], total[b] = total[a] + m, total[b] - m
    return max(sorted(members), key=lambda n: (votes[n], total[n]))


def test_prediction_equals_two_plain_steps():
    r = random.Random(6)
    langs = list(SYLLABLES) * 12
    model = LanguageModel(np.array([text_vector(sentence(r, x, 8)) for x in langs]), langs)
    texts = [sentence(r, x, n) for x in SYLLABLES for n in (1, 2, 6, 40)] + [sentence(r, "en", 4) + sentence(r, "fr", 4) for _ in range(30)]
    assert [model.predict(t)[0] for t in texts] == [plain_predict(model, t) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_machine_is_at_its_optimum(seed):
    """No step from the weights lowers the regularised squared hinge loss, and the gradient is nearly zero."""
    from folio.llm.langid import fit_svm

    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, 9)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0.1, 1.0, -1.0).astype(np.float32)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    x1 = np.hstack([x, np.ones((60, 1))])

    def loss(w):
        return 0.5 * w @ w + 30 * (weight * np.maximum(0, 1 - y * (x1 @ w)) ** 2).sum()

    w = fit_svm(x, y, cost=30.0, rounds=4000).astype(float)
    gradient = w - 2 * 30 * (x1.T @ (weight * y * np.maximum(0, 1 - y * (x1 @ w))))
    assert np.abs(gradient).max() < 1e-3
    assert all(loss(w + 1e-2 * d / np.linalg.norm(d)) > loss(w) for d in rng.normal(size=(200, 10)))
    assert loss(fit_svm(x, y).astype(float)) < loss(w) * 1.01 + 1e-6  # the production rounds come close
