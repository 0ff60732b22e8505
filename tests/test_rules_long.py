"""Long rule lists and the audit of rule tables, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import rules as R
from folio.operators.rules import ContainsRule, PartAutomaton


def plain_first(text, rules):
    return next((i for i, r in enumerate(rules) if all(p in text for p in r.parts)), None)


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abc. é𝔸"), (3, "abcdefghij")])
def test_automaton_equals_every_rule_tried(seed, alphabet):
    r = random.Random(seed)
    for _ in range(30):
        rules = [ContainsRule(tuple("".join(r.choices(alphabet, k=r.randint(0 if r.random() < 0.05 else 1, 5))) for _ in range(r.randint(1, 3))), str(i)) for i in range(r.randint(0, 25))]
        automaton = PartAutomaton(rules)
        for _ in range(20):
            text = "".join(r.choices(alphabet, k=r.randint(0, 40)))
            assert automaton.first(text) == plain_first(text, rules), (text, rules)
    assert PartAutomaton([]).first("x") is None and PartAutomaton([ContainsRule((), "t")]).first("") == 0


def test_five_thousand_rules_equal_the_case(spark):
    r = random.Random(4)
    words = [f"w{i}x" for i in range(900)]
    rules = [ContainsRule(tuple(r.sample(words, r.randint(2, 3))), f"t{i}") for i in range(5000)]
    texts = [" ".join(r.choices(words, k=60)) for _ in range(40)] + [None, "", "none of them"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {x.i: x.m for x in df.select("i", R.contains_automaton(spark, "t", rules).alias("m")).collect()}
    for i, t in enumerate(texts):
        at = None if t is None else plain_first(t, rules)
        assert got[i] == (t if at is None else f"t{at}")
    few = rules[:60]
    same = df.select((R.contains_automaton(spark, "t", few)).alias("a"), R.ordered_contains("t", few).alias("b"))
    assert same.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    with pytest.raises(ValueError):
        R.contains_automaton(spark, "t", [ContainsRule(("x" * (R.MAX_RULE_CHARS + 1),), "t")])


def test_shadowed_rules(spark):
    r = random.Random(6)
    rules = [["".join(r.choices("abc", k=r.randint(1, 4))) for _ in range(r.randint(1, 3))] for _ in range(60)] + [["é"], [None, "xy"], ["zxyz"], []] + [["qq"]]
    df = spark.createDataFrame([(i, p, "t") for i, p in enumerate(rules)], "ord int, parts array<string>, target string")
    want = {}
    for j, late in enumerate(rules):
        early = [i for i in range(j) if all(any((p or "") in (q or "") for q in late) for p in rules[i] if p)]
        if early:
            want[j] = early[0]
    assert {x.ord: x.by_ord for x in R.audit_contains(df).collect()} == want and want
    assert R.audit_contains(df.limit(0)).count() == 0


def plain_map(pairs):
    m = {}
    for k, t in pairs:
        if k is not None and t is not None:
            m[k] = min(t, m.get(k, t))
    go = {k: t for k, t in m.items() if k != t}
    out = {}
    for k in go:
        seen = [k]
        while seen[-1] in go and go[seen[-1]] not in seen:
            seen.append(go[seen[-1]])
        last = seen[-1]
        if last not in go:
            if len(seen) > 2:
                out[k] = (go[k], "chain", len(seen) - 1, last)
            continue
        at = seen.index(go[last])
        if at == 0:
            out[k] = (go[k], "cycle", len(seen), min(seen))
        else:
            out[k] = (go[k], "into cycle", at, seen[at])
    return out


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 40), (3, 90), (4, 1)])
def test_chains_and_cycles(spark, seed, n):
    r = random.Random(seed)
    pairs = [(f"k{i:02}", f"k{r.randrange(n + 5):02}") for i in range(n)] + [("k00", "k01"), (None, "k1"), ("k3", None)]
    df = spark.createDataFrame(pairs, "key string, target string")
    assert {x.key: (x.target, x.kind, x.steps, x.end) for x in R.audit_map(df).collect()} == plain_map(pairs)


def test_long_cycle_with_a_tail(spark):
    pairs = [(f"c{i}", f"c{(i + 1) % 13}") for i in range(13)] + [(f"t{i}", f"t{i + 1}") for i in range(9)] + [("t9", "c4")]
    got = {x.key: (x.kind, x.steps, x.end) for x in R.audit_map(spark.createDataFrame(pairs, "key string, target string")).collect()}
    assert got["c7"] == ("cycle", 13, "c0") and got["t0"] == ("into cycle", 10, "c4") and len(got) == 23
