import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import folio.llm.backoff_lm as B
from folio.llm.common import fold


def plain_tokens(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return [*out, "<end>"]


def plain_model(rows, order):
    """(counts, tokens, base, n-gram probability, score) straight from the definitions."""
    train = [plain_tokens(t) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    base = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    grams = Counter()
    for t in train:
        t = ["<end>", *t]
        for k in range(2, order + 1):
            for i in range(len(t) - k + 1):
                grams[tuple(t[i : i + k])] += 1

    def p(w, h):
        if not h:
            return base(w)
        seen = c[h[0]] if len(h) == 1 else grams[h]
        return (grams[(*h, w)] + B.PRIOR * p(w, h[1:])) / (seen + B.PRIOR) if seen else p(w, h[1:])

    def score(tokens):
        h, total = ("<end>",), 0.0
        for w in tokens:
            total += math.log10(p(w, h[-(order - 1) :]))
            h = (*h, w)
        return total

    return c, n, base, p, score


LEARNED = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 != 1)  # an id that is learned from


def make_rows(seed=1):
    r = random.Random(seed)
    words = ["the", "Of", "and", "cat", "dog", "ran", "sat", "é", "x1", "zebra"]
    rows = [(i, " ".join(r.choices(words, [9, 8, 7, 3, 3, 3, 2, 1, 1, 1], k=r.randint(0, 30)))) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, "the of \x1c odd"), (63, "never seen words"), (63, "never seen words"), (None, "the cat"), (70, "cat " * 20_000)]


@pytest.mark.parametrize("order,block,bucket", [(3, 1_500_000, 1_000_000), (2, 40, 30), (3, 40, 100), (3, 1, 7)])
def test_against_definitions(spark, docs_of, monkeypatch, order, block, bucket):
    monkeypatch.setattr(B, "PIECE", 512 if block > 40 else 4)
    monkeypatch.setattr(B, "ORDER", order)
    monkeypatch.setattr(B, "BLOCK_TOKENS", block)
    monkeypatch.setattr(B, "BUCKET_TOKENS", max(bucket, 20_000 // 40 if block > 1 else 2_000))
    rows = make_rows() if block > 1 else make_rows()[:25]
    c, n, base, _, score = plain_model(rows, order)
    got = B.score_documents(docs_of(rows), fold("doc_id") != 1).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        tokens = plain_tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert math.isclose(r.base_score, math.fsum(math.log10(base(w)) for w in tokens), rel_tol=1e-11)
        assert math.isclose(r.score, score(tokens), rel_tol=1e-9)


def test_probabilities_sum_to_one():
    rows = make_rows(2)
    c, _, _, p, _ = plain_model(rows, 3)
    for h in [(), ("the",), ("the", "of"), ("<end>", "the"), ("zebra",), ("never", "met")]:
        assert math.isclose(sum(p(w, h) for w in [*c, "<unseen>"]), 1, rel_tol=1e-9)


def test_no_rows_and_no_training(spark, docs_of):
    assert B.score_documents(docs_of([]), F.lit(True)).count() == 0
    got = B.score_documents(docs_of([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_rare_grams_count_at_any_size(spark, docs_of):
    text = "a rare phrase of words"
    rows = [(i, f"w{i} {text}") for i in (60, 62, 63, 64, 70)] + [(71, "cat " * 60_000)]
    c, n, base, _, score = plain_model(rows, 3)
    assert n > 60_000 and max(c[w] for w in text.split()) <= 5  # under 1e-4 of all tokens
    for r in B.score_documents(docs_of(rows), fold("doc_id") != 1).collect():
        tokens = plain_tokens(dict(rows)[r.doc_id])
        assert math.isclose(r.score, score(tokens), rel_tol=1e-9)
        assert r.doc_id == 71 or r.score > r.base_score + 5


def test_many_words(spark, docs_of):
    """Every one of very many bigrams lifts its text's score."""
    rows = [(i, f"p{i // 2} q{i // 2}") for i in range(36_000)]
    _, _, _, _, score = plain_model([(LEARNED, t) for _, t in rows], 3)
    got = B.score_documents(docs_of(rows), F.lit(True)).collect()
    texts = dict(rows)
    assert all(math.isclose(r.score, score(plain_tokens(texts[r.doc_id])), rel_tol=1e-9) and r.score > r.base_score for r in got)


@pytest.mark.parametrize("top", [0, 255, 256, 2**40])
def test_packed_numbers(top):
    a = np.array([0, 3, top, 1], np.int64)
    assert B._unpacked(B._packed(a)).tolist() == a.tolist() and len(B._unpacked(B._packed(a[:0]))) == 0
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 500, np.uint64))
    assert (B._unpacked_keys(B._packed_keys(keys)) == keys).all()


def test_automaton_walks_one_token_at_a_time():
    """A state is the longest suffix of the history that training holds, and only arcs of that state and of its failures are used."""
    rows = [(0, "a b c a b d"), (2, "b c")]
    block = B.Block.__new__(B.Block)
    tokens = [["a", "b", "c", "a", "b", "d", ""], ["b", "c", ""], ["a", "b", "z", "c", ""]]
    words = sorted({w for t in tokens for w in t}, key=lambda w: xxhash.xxh64_intdigest(w.encode()))
    number = {w: i for i, w in enumerate(words)}
    block.words = np.array([xxhash.xxh64_intdigest(w.encode()) for w in words], np.uint64)
    block.end, block.lengths = number[""], np.array([len(t) for t in tokens])
    w = len(words)
    ids = [[number[x] for x in t] for t in tokens]
    pair = [[p * w + x for p, x in zip([block.end, *t], t)] for t in ids]
    block.pairs = np.unique(np.concatenate(pair))
    at = lambda x: int(np.searchsorted(block.pairs, x))
    triple = [[at(q) * w + x for q, x in zip(p, t[1:])] for p, t in zip(pair, ids)]
    block.triples = np.unique(np.concatenate(triple))
    count = lambda known, seen: np.array([Counter(sum(seen[:2], []))[k] for k in known])
    learned = Counter(sum(ids[:2], []))
    automaton = B.Automaton(block, np.array([learned[i] for i in range(w)]), np.concatenate([count(block.pairs.tolist(), pair), count(block.triples.tolist(), triple)]), 10, 5)
    state, histories = np.array([automaton.start]), []
    for x in ids[2]:
        _, state = automaton.step(state, np.array([x]))
        s = int(state[0])
        histories.append(() if s == 0 else (words[s - 1],) if s <= w else tuple(words[i] for i in divmod(int(block.pairs[s - 1 - w]), w)))
    assert histories == [("", "a"), ("a", "b"), (), ("c",), ("c", "")] or histories == [("", "a"), ("a", "b"), (), ("c",), ("c", "")][:4] + [("c", "")]
    _, _, _, _, score = plain_model([(LEARNED, t) for _, t in rows], 3)
    got = automaton.scores(np.concatenate([np.array(t) for t in ids]), block.lengths)
    assert all(math.isclose(g, score([*t[:-1], "<end>"]), rel_tol=1e-9) for g, t in zip(got, tokens))
