import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from folio.llm.filter_audit import AUDIT_COLUMNS, COUNTED, Packed, audit, masked_documents, text_mask

DOCS = "doc_id long, lang string, text string"
LABELS = "doc_id long, quality int, toxic int"


def plain_fails(rows):
    for doc_id, lang, text in rows:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        copy = any((x or "") == t and i is not None and doc_id is not None and i < doc_id for i, _, x in rows)
        yield lang or "", doc_id, {f for f, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), copy)) if bad}


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    docs = list(plain_fails(rows))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone, before = [d for d in left if f in d[2]], left
                left = [d for d in left if f not in d[2]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in d[2] for d in mine) - sum(f in d[2] for d in before), sum(d[2] == {f} for d in mine), sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone)]
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return out


def documents(seed=3, n=150):
    r = random.Random(seed)
    long_ = " ".join(f"w{i}" for i in range(210))
    texts = [None, "", " ", "Short TEXT", "a # b", long_, long_ + " $", "same " * 300, "LOUD " * 250, long_ + " é  x", long_.upper()]
    rows = [(r.choice([None, *range(60)]), r.choice(["en", "de", None, ""]), r.choice(texts) if r.random() < 0.7 else f"{long_} {r.random()}") for _ in range(n)]
    labels = [(r.choice([None, *range(60)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(80)]
    return rows, labels


def test_equals_plain_version(spark):
    rows, labels = documents()
    docs = spark.createDataFrame(rows, DOCS).repartition(7).withColumns({c: F.lit("x") for c in ("part", "mask", "good", "digest", "id", "slot", "quality")})
    got = audit(masked_documents(docs, spark.createDataFrame(labels, LABELS).withColumn("least", F.lit(1))), "ABCDE")
    assert got.columns == AUDIT_COLUMNS
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got.collect()} == plain_audit(rows, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit(masked_documents(docs, labels), "ABCDE").collect() == []
    one = spark.createDataFrame([(1, None, None)], DOCS)
    rows = audit(masked_documents(one, labels), "ABCDE").collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and all(r.kept == 0 for r in rows if "A" in r.filter_order[: r.step])


@pytest.mark.parametrize("mask", [0, 1, 0b10110, 31])
def test_fields_do_not_run_over(mask):
    packed = Packed(5)
    word, times = packed.words[mask << 2 | 3], 2**62 + 12345
    got = packed.unpack(packed.pack(times * word))
    one = packed.unpack(packed.pack(word))
    assert got["all"] == times and all((got[c] == times * one[c]).all() for c in COUNTED)
    assert one["removed"].sum() == (120 if mask else 0) and len(packed.orders) * packed.n == 600


def test_mask_of_very_long_text():
    assert text_mask("Aa " * 10**6) == 0b0110
