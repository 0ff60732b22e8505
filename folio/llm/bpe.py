"""Byte-pair encoding and decoding of whole texts.

A word's symbols form a doubly linked list; a priority queue holds the merge
rank and position of each adjacent pair.  The lowest rank (ties: leftmost) is
popped, entries whose symbols changed meanwhile are skipped, and each merge
pushes its two new neighbours.  Decoding concatenates vocabulary strings,
with the separator that the tokenizer file's missing decoder stands for.

The vocabulary file is a parameter and is read by each worker.  Normalised
text never merges across white space, so words are encoded once and kept in
bounded per-worker caches.

Defined cases: null text counts as empty (no ids, empty decoded text); the
special tokens' strings in a text become their ids, as the tokenizers library
does by default; repeated rows are encoded each; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RecentCache, per_worker

CHUNKS = 300_000  # entries per cache generation
LINE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
#: Letters that normalising leaves alone but for their case, then plain punctuation.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿŒœ]+)([.,;:!?]*)")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in byte order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Tokenizer of one vocabulary file: NFC, white space, lower case; words end with a suffix."""

    def __init__(self, path: str, merge: str = "heap", chunks: int | None = None):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.specials.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.symbols = byte_symbols()
        self.first = [self.vocab[s] for s in self.symbols]
        self.last = [self.vocab[s + self.suffix] for s in self.symbols]
        # a pair of ids (16 bits each) to its merge rank and the merged id
        self.ranks = {self.vocab[a] << 16 | self.vocab[b]: rank << 16 | self.vocab[a + b] for rank, (a, b) in enumerate(model["merges"])}
        # the file's Unicode tables, for text outside ASCII
        self.library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = self.library.normalizer, self.library.pre_tokenizer
        self.merge = self._merge_heap if merge == "heap" else self._merge_library
        self.chunks = RecentCache(chunks or CHUNKS)  # a pre-tokenised word is a chunk too

    def _merge_heap(self, word: bytes) -> list[int]:
        ids = [self.first[b] for b in word]
        ids[-1] = self.last[word[-1]]
        n = len(ids)
        if n == 1:
            return ids
        rank_of = self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = rank_of(ids[i] << 16 | ids[i + 1])
            if m is not None:
                heap.append((m >> 16) << 40 | i)
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & 0xFFFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue  # stale: merged away
            m = rank_of(ids[i] << 16 | ids[j])
            if m is None or m >> 16 != entry >> 40:
                continue  # stale: another pair stands there now
            k = after[j]
            ids[i], ids[j], after[i] = m & 0xFFFF, -1, k
            if k < n:
                before[k] = i
                m = rank_of(ids[i] << 16 | ids[k])
                if m is not None:
                    heapq.heappush(heap, (m >> 16) << 40 | i)
            h = before[i]
            if h >= 0:
                m = rank_of(ids[h] << 16 | ids[i])
                if m is not None:
                    heapq.heappush(heap, (m >> 16) << 40 | h)
        return [x for x in ids if x >= 0]

    def _merge_library(self, word: bytes) -> list[int]:
        return [t.id for t in self.library.model.tokenize("".join(map(self.symbols.__getitem__, word)))]

    def word_ids(self, word: str) -> bytes:
        """Ids of one pre-tokenised word, as little-endian unsigned 32-bit integers."""
        ids = self.chunks.get(word)
        if ids is None:
            ids = array("I", self.merge(word.encode())).tobytes()
            if len(word) <= 200:  # longer ones are not worth a place
                self.chunks.put(word, ids)
        return ids

    def split(self, text: str) -> list[str]:
        """Normalised words of a text that holds no special token."""
        if text.isascii():
            return LINE.findall(text.lower())
        text = self.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk that is not in the cache."""
        plain = PLAIN.fullmatch(chunk)
        if plain:
            word, marks = plain[1].lower(), plain[2]
            if word == chunk:
                ids = array("I", self.merge(word.encode())).tobytes()
            else:
                ids = self.word_ids(word) + (self.word_ids(marks) if marks else b"")
        else:
            ids = b"".join(map(self.word_ids, self.split(chunk)))
        if len(chunk) <= 200:
            self.chunks.put(chunk, ids)
        return ids

    def _plain(self, text: str) -> bytes:
        chunks = text.split()
        found = list(map(self.chunks.young.get, chunks))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    ids = self.chunks.get(chunks[i])
                    found[i] = self._chunk(chunks[i]) if ids is None else ids
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "<|" in text:
            parts = self.special_split.split(text)
            if len(parts) > 1:
                return b"".join(array("I", [self.specials[p]]).tobytes() if k % 2 else self.encode(p) for k, p in enumerate(parts))
        if SEPARATORS.search(text):  # split() would part words there, the vocabulary's pattern doesn't
            return b"".join(map(self.word_ids, self.split(text)))
        return self._plain(text)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, array("I", ids)))


SEPARATORS = re.compile("[\x1c-\x1f]")


def tokenizer(path: str, merge: str = "heap", chunks: int | None = None) -> WordBpe:
    """The worker's tokenizer for a vocabulary file (built once per worker); ``chunks``: entries per cache generation."""
    return per_worker(("bpe", path, merge, chunks), lambda: WordBpe(path, merge, chunks))


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``id, n_tokens, ids, decoded`` per row; with ``digests`` SHA-256 of both instead.

    One narrow pass; rows leave in the order they came.
    """
    id_type = docs.schema[id_col].dataType
    outputs = [("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())] if digests else [("ids", T.ArrayType(T.LongType())), ("decoded", T.StringType())]
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_tokens", T.LongType()), *(T.StructField(n, t) for n, t in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocab_path)
        for batch in batches:
            n, a, b = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                decoded = bpe.decode(ids)
                n.append(len(ids) // 4)
                if digests:
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(decoded.encode()).hexdigest())
                else:
                    a.append(array("I", ids).tolist())
                    b.append(decoded)
            kind = pa.string() if digests else pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, kind), pa.array(b, pa.string())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
