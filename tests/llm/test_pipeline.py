"""The pipeline's stages against brute-force versions on a small table of documents."""

import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from folio.llm.simhash import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ["nasty", "awful", "hateful", "vilest"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(12)
    word = lambda: "".join(r.choices(["an", "the", "or", "is", "to", "ba", "mi", "ko", "lu"], k=r.randint(1, 4)))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(r.randint(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for w in r.sample(BAD, 2):
                words.insert(r.randrange(len(words)), w)
        if i % 7 == 1:
            words.insert(3, r.choice(["joe@mail.example.com", "10.2.3.4", "+1 (988) 555-2485", "4111 1111 1111 1111"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    clean = [t for i, t in rows if i % 4]
    rows += [(400 + i, clean[i]) for i in range(20)]  # exact copies
    rows += [(500 + i, clean[40 + i] + " " + word()) for i in range(20)]  # near copies
    rows += [(600 + i, clean[100]) for i in range(50)] + [(700, None), (701, ""), (649, clean[100]), (None, "a row without id")]
    path = tmp_path_factory.mktemp("pipeline")
    full = [(i, t, None if i == 5 else "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), full


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "pii", "packing"]
    take = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    stages = dict(P.STAGES)

    got = stages["toxicity"](spark, docs, path)
    assert got.columns == docs.columns
    want = [r for r in rows if not set((r[1] or "").split()) & set(BAD)]
    assert take(got) == sorted(want, key=str)

    docs = spark.createDataFrame(want, SCHEMA)
    best = {}
    for r in want:
        key = r[1] or ""
        if key not in best or (r[0] is not None and (best[key][0] is None or r[0] > best[key][0])):
            best[key] = r
    want = sorted(best.values(), key=str)
    assert take(stages["exact_dedup"](spark, docs, path)) == want

    docs = spark.createDataFrame(want, SCHEMA)
    prints = {r[0]: simhash(r[1]) for r in want}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints, key=lambda i: (i is None, i or 0))
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)), key=ids.index)
                root[y] = x
    want = sorted((r for r in want if find(r[0]) == r[0]), key=str)
    assert take(stages["simhash_dedup"](spark, docs, path)) == want

    docs = spark.createDataFrame(want, SCHEMA)
    redacted = stages["pii"](spark, docs, path)
    got = {r.doc_id: r for r in redacted.collect()}
    assert redacted.columns == docs.columns and len(got) == len(want)
    for i, text, lang, source, n in want:
        for span, kind in [("joe@mail.example.com", "email"), ("10.2.3.4", "ip"), ("+1 (988) 555-2485", "phone"), ("4111 1111 1111 1111", "card")]:
            text = text.replace(span, f"[{kind}]") if text else text
        assert tuple(got[i]) == (i, text, lang, source, n if text is None else len(text))

    packed = stages["packing"](spark, redacted, path).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want_ids = {i: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for i, r in got.items()}
    assert sum(p.length for p in packed) == sum(map(len, want_ids.values()))
    for p in packed:
        ids = want_ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)) and p.doc_tokens == len(want_ids[p.doc_id])


def test_run_is_the_stages_one_after_another(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), stage(spark, docs, path).schema)
    cut = lambda df: sorted((r.doc_id or -1, r.start, r.ids_crc32) for r in df.collect())
    assert cut(P.run(spark, path)) == cut(docs)


ODD = "doc_id long, text string, lang string, source string, n_chars long, kept_id long, text_sha256 string, chosen_id int, fp int, times int, root int, sha256 string"


def odd_documents(spark):
    """Repeated ids with different texts, several null ids, repeated rows, and columns named as the stages name theirs."""
    near = "one two three four five six seven eight nine ten eleven twelve " * 9
    far = ["alpha beta gamma delta " * 3, "completely other words stand here today", "yet another unlike text of this table"]
    texts = [(7, near + "a"), (3, near + "b"), (7, far[0]), (3, near + "b"), (None, far[1]), (None, far[1] + " "), (None, far[2]), (None, near), (9, far[2]), (9, None), (None, None), (None, ""), (5, far[0])]
    return spark.createDataFrame([(i, t, "en", "s", None, 1, "x", k % 2, 3, 4, 5, "y") for k, (i, t) in enumerate(texts)], ODD).repartition(3)


def test_stages_keep_one_row_of_each_group(spark, tmp_path):
    docs = odd_documents(spark)
    stages = dict(P.STAGES)
    got = stages["exact_dedup"](spark, docs, "")
    rows = got.collect()
    assert got.columns == docs.columns
    assert sorted(r.text or "" for r in rows) == sorted({r.text or "" for r in docs.collect()})
    assert {r.doc_id for r in rows if r.text and r.text.startswith("alpha")} == {7}
    for df in (docs, spark.createDataFrame(rows, docs.schema)):
        all_rows = df.collect()
        got = stages["simhash_dedup"](spark, df, "")
        rows = got.collect()
        assert got.columns == docs.columns
        groups = {}
        for r in all_rows:  # what is further apart than the limit here is far apart
            key = next((k for k in groups if (k ^ simhash(r.text)).bit_count() <= 4), simhash(r.text))
            groups.setdefault(key, []).append(r)
        assert len(rows) == len(groups)
        for r in rows:
            group = next(g for k, g in groups.items() if (k ^ simhash(r.text)).bit_count() <= 4)
            ids = [x.doc_id for x in group if x.doc_id is not None]
            assert r in group and r.doc_id == (min(ids) if ids else None)
    for name in ("exact_dedup", "simhash_dedup", "pii", "packing"):
        assert stages[name](spark, docs.limit(0), "").count() == 0


def test_run_leaves_only_the_last_tables(spark, folder):
    from folio.llm.common import WRITTEN

    before = len(WRITTEN)
    P.run(spark, folder[0]).count()
    assert not [p for p in WRITTEN[before:] if any(n in p for n in ("digests", "near-", "kept-", "fingerprints", "toxicity-", "exact_dedup-"))]
