import random
import struct
import zlib
from itertools import product

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import folio.llm.packing as P
from folio.llm.packing import closest_fill, pack_documents, plan_windows, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def test_closest_fill_against_all_multisets():
    r = random.Random(6)
    for _ in range(300):
        counts = {r.randint(1, 30): r.randint(1, 4) for _ in range(r.randint(0, 5))}
        target = r.randint(0, 70)
        best = max((s for ns in product(*(range(c + 1) for c in counts.values())) if (s := sum(a * b for a, b in zip(ns, counts))) <= target), default=0)
        used = closest_fill(sorted(counts), counts, target)
        assert sum(k * n for k, n in used.items()) == best
        assert all(0 < n <= counts[k] for k, n in used.items())


def test_plan_uses_every_piece_once():
    r = random.Random(8)
    counts = {}
    for _ in range(2000):
        n = r.randint(1, 2047)
        counts[n] = counts.get(n, 0) + 1
    total, left, windows = sum(k * n for k, n in counts.items()), dict(counts), 0
    for pattern, times in plan_windows(dict(counts)):
        assert sum(k * n for k, n in pattern.items()) <= 2048 and times > 0
        windows += times
        for k, n in pattern.items():
            left[k] -= n * times
    assert not any(left.values())
    assert total / (windows * 2048) > 0.99


def test_documents(spark, docs_of, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ROWS", 7)
    words = "the cat sat on a mat and ran".split()
    r = random.Random(9)
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 90)))) for i in range(40)] + [(40, None), (41, ""), (42, " ".join(r.choices(words, k=3000))), *[(60 + i, " ".join(r.choices(words, k=400))) for i in range(12)], (43, "the " * 127), (5, "a twin id"), (None, "no id")]
    packed = pack_documents(docs_of(rows, parts=6), PATH, window=128, with_ids=True).cache()
    want = sorted(([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows), key=str)
    got = packed.collect()
    docs = {}
    for p in got:
        assert p.length == len(p.ids) <= 128 and p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *p.ids))
        docs.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    rebuilt = [[x for p in sorted(ps, key=lambda p: p.start) for x in p.ids] for ps in docs.values()]
    assert all(len(ids) == n for (_, n), ids in zip(docs, rebuilt)) and sorted(rebuilt, key=str) == want
    by_sequence = {}
    for p in got:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    rows_out = {s.sequence_id: s.ids for s in sequences(packed, 128, pad_id=7).collect()}
    for k, parts in by_sequence.items():
        n = sum(length for _, length in parts)
        assert len(rows_out[k]) == (n if n & (n - 1) == 0 else 128) and rows_out[k][n:] == [7] * (len(rows_out[k]) - n)
    assert pack_documents(docs_of([]), PATH).count() == 0


@pytest.mark.parametrize("text", [None, ""])
def test_empty_text_is_its_closing_id(spark, docs_of, text):
    (p,) = pack_documents(docs_of([(9, text)]), PATH).collect()
    assert (p.doc_id, p.start, p.length, p.doc_tokens, p.offset, p.ids_crc32) == (9, 0, 1, 1, 0, zlib.crc32(struct.pack("<I", 1)))


def test_equal_rows_are_dealt_to_all_shards(spark, docs_of):
    """Rows that repeat an id and text do not meet in one shard."""
    from folio.llm.packing import pack_documents

    got = pack_documents(docs_of([(None, "the same words again")] * 400 + [(1, "others")]), public_tokenizers.path("word_bpe_49k.json"), shards=8).collect()
    assert len(got) == 401
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.sequence_id >> 24, []).append(r)
    assert len(by_shard) == 8 and max(map(len, by_shard.values())) < 100
