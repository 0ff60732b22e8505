"""Queries without SQL against plain versions, on a small folder of documents."""

import difflib
import unicodedata

import pytest

from folio.operators.matching import distinct_index_sets
from folio.plans import catalogue as C
from folio.plans import inputs as I

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    words = "alpha beta gamma delta ﬁne Ǆungla é́x Straße under over".split()
    line = lambda i, j: " ".join(words[(i * 7 + j * 3 + k) % len(words)] for k in range(2 + (i + j) % 5))
    rows = [(i, "\n".join(line(i, j) for j in range(n)), ("en", "fr", "es", "de")[i % 4], f"s{i % 3}", 0) for i, n in enumerate([1, 3, 4, 9, 27, 28, 29, 40] * 3)]
    rows += [(90, "", "en", "s", 0), (91, "x" * 900 + "\n" + "\n".join(["ab cd"] * 30), "fr", "s", 0)]
    path = tmp_path_factory.mktemp("ratio")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def ratio(a, b):
    return 100 if a == b else round(100 * difflib.SequenceMatcher(None, a, b).ratio()) if a and b else 0


def best(lines, keyword, least):
    all_ = [(ratio(keyword, t), -o, t) for o, ix in distinct_index_sets() if len(lines) >= least and max(ix) < len(lines) for t in [" ".join(lines[i] for i in ix)]]
    return max(all_, key=lambda x: x[:2]) if all_ else None


def shifted(s):
    return s.translate(str.maketrans(*I.VOWEL_SHIFT))


@pytest.mark.parametrize("query,least", [(C.best_line_ratio, 28), (C.best_line_ratio_short, 4)])
def test_best_line_ratio(spark, folder, query, least):
    path, rows = folder
    got = {r.doc_id: (r.score, r.ord, r.text) for r in query(spark, path).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        lines = text.split("\n")
        want = best(lines, shifted(lines[0]), least)
        assert got[i] == ((None, None, None) if want is None else (want[0], -want[1], unicodedata.normalize("NFKD", want[2]).strip()))


def test_title_validation_ratio(spark, folder):
    path, rows = folder
    got = {r.doc_id: (r.doc_title, r.title_ok, r.score) for r in C.title_validation_ratio(spark, path).collect()}
    for i, text, lang, *_ in rows:
        lines = "".join(c if ord(c) < 128 else "x" for c in text).split("\n")
        l0 = lines[0]
        title = {"en": l0.upper(), "es": shifted(l0), "fr": l0[: max(0, len(l0) - 1)] + "#"}.get(lang, l0)
        want = best(lines, title, C.VALIDATION_MIN_LINES)
        doc = "Error" if want is None else want[2].strip()
        title = title if text else "None"  # an empty text has no line
        score = ratio(doc.lower(), title.lower())
        assert got[i] == (doc, score == 100, score), (i, title)


def test_nfkd_text(spark, folder):
    import hashlib

    path, rows = folder
    want = {i: unicodedata.normalize("NFKD", t) for i, t, *_ in rows}
    assert {r.doc_id: (r.n_chars, r.text_md5) for r in C.nfkd_text(spark, path).collect()} == {i: (len(t), hashlib.md5(t.encode()).hexdigest()) for i, t in want.items()}
