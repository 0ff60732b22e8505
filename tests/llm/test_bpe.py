import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folio.llm.bpe import WordBpe, byte_symbols, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    None, "", " \n\t ", "don't WE'LL o'clock's", "a\x1cb c\x1f", "x<|endoftext|>y <|end <|startoftext|>", "İΣσΑΣ ǅ ß ẞ", "é ́x", "ẛ̣ a\u2003b\u00a0c\u0085d",
    "1234 ٣٤ ½ ²", "日本語 テキスト", "👍🏽 hi!!! ...,,,.'s 's", "x\x00y", "ᾼ ſ K Å", "'" * 50, "a" * 5000 + "'s", "The, the. THE; œuvre Ärger", "\u200b\u2060z", "Ⅷ ⅷ ⓐ",
]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("merge", ["heap", "library"])
def test_ids_and_round_trip_equal_the_library(merge):
    bpe, r = WordBpe(PATH, merge), random.Random(4)
    alphabet = ["the", "Ing", "tion", "é", "ß", "'s", "'ll", ".", ",", " ", " ", "\n", "7", "x", "Σ", "\u0301", "漢", "<|", "|>", "\x1d", "qu", "ZZ"]
    texts = ODD + ["".join(r.choices(alphabet, k=r.randint(1, 40))) for _ in range(1500)]
    for text in texts:
        ids = list(struct.unpack(f"<{len(bpe.encode(text)) // 4}I", bpe.encode(text)))
        assert ids == expected(text), text
        assert bpe.decode(bpe.encode(text)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_caches_forget_without_changing_ids(monkeypatch):
    import folio.llm.bpe as M

    monkeypatch.setattr(M, "CHUNKS", 3)
    bpe = WordBpe(PATH)
    text = " ".join(f"word{i % 7}, Other{i % 5}" for i in range(60))
    assert list(struct.unpack(f"<{len(bpe.encode(text)) // 4}I", bpe.encode(text))) == expected(text)
    assert len(bpe.chunks.young) <= 3 and len(bpe.chunks.old) <= 3


def test_byte_symbols_are_the_vocabularys():
    vocab = LIBRARY.get_vocab()
    assert len(set(byte_symbols())) == 256 and all(s in vocab and s + "</w>" in vocab for s in byte_symbols())


def test_documents(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id"), (99, "long words here " * 50_000)]
    got = encode_documents(docs_of(rows), PATH, digests=True).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        ids = expected(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    plain = {r.doc_id: (r.ids, r.decoded) for r in encode_documents(docs_of([(1, "Hello, world"), (2, None)]), PATH).collect()}
    assert plain == {1: (expected("Hello, world"), LIBRARY.decode(expected("Hello, world"))), 2: ([], "")}
    assert encode_documents(docs_of([]), PATH).count() == 0
