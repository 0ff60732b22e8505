"""Steps whose work must not outgrow their input: what they give, and what they leave out."""

import random
import re

import numpy as np
import pytest

from folio.functions import blocks, segments, text
from folio.operators import rules as R
from folio.operators import updates as U


def edited(rnd, s, k):
    s = list(s)
    for _ in range(k):
        i = rnd.randrange(len(s) + 1)
        s[i : i + rnd.randint(0, 1)] = rnd.choice(["", "x", "ab"[rnd.randint(0, 1)]])
    return "".join(s)


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1]


@pytest.mark.parametrize("seed", range(3))
def test_near_strings_share_a_segment(seed):
    rnd, bits, every = random.Random(seed), 20, np.full(1 << 14, (1 << 64) - 1, np.uint64)
    for n in [*range(9, 40), 63, 64, 65, 127, 200, 1025]:
        s = "".join(rnd.choices("abcdeé𝄞 ", k=n))
        k = int(int(n / 0.9 + 1e-9) * 0.1 + 1e-9)
        width, keys, places = segments.given(s, k)
        others = [t for t in (edited(rnd, s, rnd.randint(0, k)) for _ in range(20)) if lev(s, t) <= k]
        of, found, at = segments.looked_up(others, [width], every, bits)  # a full bitmap holds back nothing
        given = set(zip(keys, places))
        for i in range(len(others)):
            assert any((h, q) in given for h, p in zip(found[of == i].tolist(), at[of == i].tolist()) for q in range(p - k, p + k + 1))
    unlike = ["".join(rnd.choices("qrstuvw", k=60)) for _ in range(50)]
    table = np.zeros(1 << 14, np.uint64)
    for h in keys:
        table[(h & (1 << bits) - 1) >> 6] |= np.uint64(1 << (h & 63))
    assert len(segments.looked_up(unlike, [width], table, bits)[0]) < 50 * 60 * 0.1


def test_packed_texts_equal_one_by_one():
    rnd = random.Random(4)
    for alphabet in ("ab", "abc \0", "aéü𝄞b"):
        for _ in range(40):
            texts = ["".join(rnd.choices(alphabet, k=rnd.choice([0, 1, 3, 20, 70]))) for _ in range(rnd.randint(1, 9))]
            s = "".join(rnd.choices(alphabet, k=rnd.choice([0, 1, 5, 33, 80])))
            assert blocks.Packed(texts).distances(s).tolist() == [lev(s, t) for t in texts]


def test_strip_is_pythons(spark):
    assert set(text.PY_SPACES) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    rnd = random.Random(3)
    rows = [("".join(rnd.choices([*text.PY_SPACES, "a", "é", "​", "𝄞"], k=rnd.randint(0, 8))),) for _ in range(500)]
    df = spark.createDataFrame(rows, "s string").select("s", text.py_strip("s").alias("t"))
    assert all(r.t == r.s.strip() for r in df.collect()) and "regexp" not in df._jdf.queryExecution().toString()


def test_equal_rules_meet_once(spark):
    # a number of two rows: each of them hides what holds it
    rows = [(1, ["x"]), (1, ["yy"]), (2, ["x", "z"]), (3, ["ayyb"])] + [(i, ["p", "q#1"]) for i in range(10, 400)] + [(500, ["q#12", "opt", "r"])]
    df = spark.createDataFrame([(o, p, "") for o, p in rows], "ord int, parts array<string>, target string")
    want = {2: 1, 3: 1, 500: 10} | {i: 10 for i in range(11, 400)}
    assert {r.ord: r.by_ord for r in R.audit_contains(df).collect()} == want


def test_rules_that_hold_many_parts(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, ["".join(rnd.choices("ab", k=rnd.randint(1, 5))) for _ in range(rnd.randint(1, 4))]) for i in range(120)]
    df = spark.createDataFrame([(o, p, "") for o, p in rows], "ord int, parts array<string>, target string")
    holds = lambda late, early: all(any(e in t for t in late) for e in early)
    want = {o: min(hiding) for o, p in rows if (hiding := [e for e, q in rows if e < o and holds(p, q)])}
    for most in (3, 48):
        monkeypatch.setattr(R, "PAIRED", most)
        assert {r.ord: r.by_ord for r in R.audit_contains(df).collect()} == want


def test_corrections_leave_the_author_list_behind(spark):
    schema = "record_key string, title string, authors struct<author:array<struct<fname:string,mname:string,lname:string>>>, fields struct<field:array<struct<_name:string,_type:string,value:array<string>>>>"
    people = [("A", "M", "B"), ("C", "", "D")]
    records = spark.createDataFrame([("k", "t", (people,), ([("rights_holder", "string", ["old"])],)), ("n", "t", ([],), ([],)), ("z", "t", None, None)], schema)
    given = spark.createDataFrame([("k", None, "X", "None", "Y", "Agronomy")], "record_key string, title string, fname string, mname string, lname string, major string")
    out = U.apply_corrections(records, given)
    rows = {r.record_key: r for r in out.collect()}
    assert [tuple(a) for a in rows["k"].authors.author] == [("X", "M", "Y"), ("C", "", "D")] and rows["z"].authors.author == []
    assert [(f._name, f.value) for f in rows["k"].fields.field] == [("rights_holder", ["X M Y"]), ("major", ["Agronomy"])]
    plan = out.select("record_key", "fields")._jdf.queryExecution().optimizedPlan().toString()
    assert not any(re.search(r"[\[ ]authors#\d+[,\]]", line) for line in plan.splitlines() if "Project" in line)


def test_word_hashes_of_whole_texts(monkeypatch):
    from folio.llm import set_join

    rnd, hashes = random.Random(5), set_join.WordHashes()
    for _ in range(300):
        raw = "".join(rnd.choices("aAbB\t \x0b\x1c\0é\n", k=rnd.randint(0, 40))).encode()
        words, got = raw.lower().split(), hashes.words(raw).tolist()
        assert len(got) == len(words) and len(set(got)) == len(set(words))
        assert got == [hashes.words(w).tolist()[0] for w in words]
        monkeypatch.setattr(set_join, "PIECE", 7)
        assert hashes.words(raw).tolist() == got
        monkeypatch.setattr(set_join, "PIECE", 1 << 18)


def test_ratio_may_stop_below_the_best():
    rnd = random.Random(6)
    for _ in range(300):
        a, b = ("".join(rnd.choices("abc ", k=rnd.randint(1, 40))) for _ in range(2))
        whole = sum(k for _, _, k in blocks.matching_blocks(a, b))
        for least in range(0, 40, 5):
            part = sum(k for _, _, k in blocks.matching_blocks(a, b, least))
            assert part == whole if whole >= least else part <= whole
