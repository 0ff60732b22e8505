import random
import re

import pytest
from pyspark.sql import functions as F

from folio.llm.pii import SpanModel, all_spans, base_spans, candidates, fit, find_spans, luhn, redact, windows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_match_the_patterns():
    r = random.Random(2)
    pieces = ["a@b.c", "x.y+z@h-1.co.uk", "@", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+44.20", " ", ".", "-", "é", "7", "12", "+", "\n", "Ω@x.y", "%@a.b", "1.2.3", "4276879267539117"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert base_spans(text) == plain_base(text), text


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


@pytest.mark.parametrize("text", ["1" * 200_000, "@" * 50_000, "a" * 200_000 + "@", "+1" + " " * 100_000, "1." * 50_000, "1 2 " * 20_000])
def test_long_texts_end(text):
    assert isinstance(all_spans(text, SpanModel())[1], list)


def model_of(spark):
    r = random.Random(7)
    card = lambda: next(c for c in iter(lambda: "4" + "".join(r.choice("0123456789") for _ in range(15)), "") if luhn(c))
    rows = []
    for i in range(300):
        rows.append(f"some words {r.choice(['to', 'in', 'on'])} +1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)} and more")
        rows.append(f"words {card()} end. and version 2.{i % 9} of {r.randint(1000, 9999999999999999)}x")
        rows.append(f"at {r.randint(1, 255)}.{r.randint(1, 255)}.{i % 256}.7 or joe{i}@mail{i % 7}.example.com here")
    return fit(spark.createDataFrame([(t,) for t in rows], "text string"))


def test_model_adds_what_the_patterns_miss(spark, docs_of):
    model = model_of(spark)
    for text, want in [("ring (415) 555-1234 now", "(415) 555-1234"), ("ring 415-555-1234 now", "415-555-1234"), ("card 4111.1111.1111.1111 ok", "4111.1111.1111.1111")]:
        base, spans = all_spans(text, model)
        assert not base and [text[a:b] for _, a, b in spans] == [want]
    assert all_spans("version 2.0 of 17 things", model) == ([], [])
    # decoding is the best segmentation: brute force over all of them
    for text in ["a +1 (988) 555-2485 4111111111111111 b", "1.2.3.4 5.6.7.8 9999", "x@y.z 1.2.3.4"]:
        total = 0.0
        for begin, end in windows(text):
            bounds, segs = candidates(text, begin, end)
            from folio.llm.pii import KINDS, features

            scored = [(i, j, max(model.score(k, features(text, bounds[i], bounds[j])) for k in KINDS)) for i, j in segs]

            def best(at):
                return max([0.0, *(s + best(j + 1) for i, j, s in scored if i >= at)])

            total += best(0)
        got = sum(model.score(k, features(text, a, b)) for k, a, b in model.decode(text))
        assert abs(total - got) < 1e-9
    rows = [(1, "mail a@b.co or (415) 555-1234"), (2, None), (3, ""), (4, "clean"), (4, "clean"), (5, "x " * 90_000 + "a@b.co")]
    got = {(r.doc_id, tuple((s.kind, s.start, s.end, s.base) for s in r.spans)) for r in find_spans(docs_of(rows), model).collect()}
    assert got == {(1, (("email", 5, 11, True), ("phone", 15, 29, False))), (2, ()), (3, ()), (4, ()), (5, (("email", 180_000, 180_006, True),))}
    red = redact(docs_of(rows).withColumn("extra", F.lit(1)), model)
    assert {(r.doc_id, r.text, r.extra) for r in red.collect() if r.doc_id < 5} == {(1, "mail [email] or [phone]", 1), (2, None, 1), (3, "", 1), (4, "clean", 1)}
    assert find_spans(docs_of([]), fit(docs_of([]))).count() == 0


def test_rare_personal_data_is_learned_from(spark, docs_of):
    """Of very many texts without any, those with personal data still train the model."""
    import folio.llm.pii as M

    rows = [(i, "plain words of no interest here") for i in range(30_000)]
    rows += [(40_000 + i, f"call me at +1 (988) 555-{1000 + i} or mail joe{i}@mail.example.com today") for i in range(60)]
    seen = []
    real = M.SpanModel.step

    def step(self, n, segments, gold, rate):
        seen.append(bool(gold))
        return real(self, n, segments, gold, rate)

    M.SpanModel.step = step
    try:
        M.fit(docs_of(rows), max_texts=200, max_windows=300)
    finally:
        M.SpanModel.step = real
    assert sum(seen) >= 100
