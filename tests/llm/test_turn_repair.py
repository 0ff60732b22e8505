import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from folio.llm import turn_repair as R
from folio.llm.turn_repair import damage, repair

SCHEMA = "conv_id long, turn long, role string, text string"


def blank(text):
    return not text.strip(" \t\n\x0b\x0c\r")


def faults_of(rows):
    seen, out = set(), []
    for turn, role, text in rows:
        cut = text.rstrip(" \t\n\x0b\x0c\r")[-1:] not in (".", "!", "?")
        out.append("blank" if blank(text) else "duplicate" if (role, text) in seen else "truncated" if cut else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All states after each row, with the least (cost, audit, repaired) that leads there; more inserts than four in a row never pay."""
    may = {"": "su", "s": "u", "u": "a", "a": "u"}  # by the last initial

    def grown(best):
        for _ in range(4):
            for last, (cost, audit, made) in list(best.items()):
                for name in ("user", "assistant"):
                    if name[0] in may[last]:
                        new = (cost + 3, audit + "I", [*made, f"{name}:"])
                        if name[0] not in best or new[:2] < best[name[0]][:2]:
                            best[name[0]] = new
        return best

    best = grown({"": (0, "", [])})
    for (turn, role, text), fault in zip(rows, faults):
        after = {}
        for last, (cost, audit, made) in best.items():
            ways = [(last, cost + 4, "D", made)]
            extra = 3 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[0] in may[last]:
                    ways.append((role[0], cost + extra, "K", [*made, f"{role}:{text}"]))
                ways += [(name[0], cost + extra + 3, "R", [*made, f"{name}:{text}"]) for name in ("user", "assistant") if name[0] in may[last]]
            for state, c, edit, made_ in ways:
                new = (c, audit + edit, made_)
                if state not in after or new[:2] < after[state][:2]:
                    after[state] = new
        best = grown(after)
    return min((v for k, v in best.items() if k in ("", "a")), key=lambda v: v[:2])


def plain(rows):
    """Expected result of one conversation's rows (turn, role, text), in any order, by definition."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults = faults_of(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, made = cheapest(rows, faults)
    assert re.fullmatch("(s?(ua)+)?", "".join(m[0] for m in made))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        how = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def by_conversation(rows, ids):
    out = {c: [] for c in ids}
    for conv, *row in rows:
        out[conv].append(tuple(row))
    return {c: plain(r) for c, r in out.items()}


def conversations(seed, n=60, most=14):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "why", "So? ", "", " \n", "é.", "cut off", "a " * 50 + "."]
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, most)):
            if r.random() < 0.1:
                continue
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = None if r.random() < 0.05 else r.choice(texts) if r.random() < 0.4 else f"{conv} {turn} words."
            rows += [(conv if conv else None, None if r.random() < 0.05 else turn, role, text)] * r.choice([1, 1, 1, 1, 2, 3])
    return rows


def results(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize("chunk", [R.CHUNK, 2])
def test_equals_plain_version(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = conversations(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("n", "digest", "times", "how", "audit", "part", "at")})
    expected = by_conversation(damaged(rows), {r[0] for r in rows})
    got = repair(damage(df), df, times="times")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert results(got) == expected


def test_one_long_conversation_lies_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 7)
    r = random.Random(5)
    rows = [(1, t, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["Yes.", f"{t} ok.", "cut", ""])) for t in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert results(repair(df, df)) == by_conversation(rows, {1})


def test_repeated_rows_and_missing_conversations(spark):
    rows = [(1, 0, "user", "Hi.")] * 40000 + [(2, None, "user", "Hi.")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    ids = df.unionByName(spark.createDataFrame([(9, 1, "user", "x")], SCHEMA))
    got = results(repair(df, ids))
    assert got[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2] == plain([r[1:] for r in rows if r[0] == 2])
    assert got[1][1:6] == (0, 39999, 0, 39999, 39999 * 4 + 3) and got[1][6] == "K" + "D" * 39999 + "I"


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair(damage(df), df, times="times").collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_backward_vectors_converge(seed):
    """A chunk started from the speculative vector, then run again from the true one, has the vectors of a whole run."""
    r = random.Random(seed)
    codes = bytes(r.choice([0, 1, 1, 2, 2, 3, 5, 9, 10, 6]) for _ in range(300))
    whole = R.backwards(codes, R.END_COSTS)
    left = R.backwards(codes[:200], R.SPECULATIVE)
    assert R.backwards(codes[:200], whole[200], left) == whole[:201]
