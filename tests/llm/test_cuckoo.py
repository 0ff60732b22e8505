import hashlib
import random

from folio.llm.cuckoo import CuckooIndex, apply_changes, exact_groups


def digest(x):
    return hashlib.sha256(str(x).encode()).digest() + (8).to_bytes(8, "little")


def test_index_against_a_dict():
    r, index, plain = random.Random(3), CuckooIndex(1), {}
    for _ in range(6000):
        d = digest(r.randrange(2500))
        if r.random() < 0.3:
            assert index.delete(d) == (plain.pop(d, None) is not None)
        elif d in plain:
            assert index.get(d) == plain[d]
        else:
            plain[d] = r.random()
            index.insert(d, plain[d])
    assert dict(index.items()) == plain and index.count == len(plain) and index.mask > 255
    assert all(index.get(digest(x)) == plain.get(digest(x)) for x in range(2500))


def test_same_fingerprint_and_bucket_is_verified():
    index, a = CuckooIndex(), digest(1)
    b = a[:10] + bytes(30)  # same bucket and fingerprint, other digest
    index.insert(a, 1)
    assert index.get(b) is None and not index.delete(b)
    index.insert(b, 2)
    assert (index.get(a), index.get(b)) == (1, 2)


def test_groups(spark, docs_of):
    long = "word " * 100_000
    rows = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, long), (7, long), (8, "a "), (8, "a "), (None, "a"), (None, "n")] + [(100 + i, "hot") for i in range(600)]
    got = exact_groups(docs_of(rows)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    want = sorted((str(i), str(best[t or ""]), len(groups[t or ""]), i == best[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert exact_groups(docs_of([])).count() == 0


def test_changes(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    index = spark.createDataFrame([(sha("a"), 1, 10), (sha("b"), 1, 11)], "text_sha256 string, n_bytes long, live_id long")
    changes = spark.createDataFrame(
        [(sha("a"), 1, 0, 1, "delete"), (sha("c"), 1, 12, 2, "insert"), (sha("c"), 1, 13, 3, "insert"), (sha("b"), 1, 3, 4, "insert"), (sha("z"), 1, 0, 5, "delete"), (sha("d"), 1, 9, 6, "insert"), (sha("d"), 1, 9, 7, "delete")],
        "text_sha256 string, n_bytes long, live_id long, seq long, op string",
    )
    got = {(r.text_sha256, r.live_id) for r in apply_changes(index, changes, 3).collect()}
    assert got == {(sha("b"), 11), (sha("c"), 13)}
