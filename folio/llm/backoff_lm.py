"""Language-model scoring with a weighted backoff automaton.

Tokens are the white-space-parted words of a text, A-Z lower-cased, then one
end.  Two models score every whole text: the base, a smoothed unigram model of
all training words, and an n-gram model over it.  The n-gram model is a
hierarchical Dirichlet one: after a history h seen c(h) times a token w has
probability (c(hw) + PRIOR * p(w | h without its first token)) / (c(h) + PRIOR).
It is scored as an automaton: a state is a history of up to ``ORDER - 1``
tokens that training texts hold, an arc carries a token's log-probability and
the next state (the longest suffix of the new history that is a state), and a
failure arc carries log10(PRIOR / (c(h) + PRIOR)) to the history without its
first token.  The root gives the base probability.  Each text is walked once
from left to right: its state takes the token's arc, or the failure arc and
then tries again.  The texts of a block walk side by side.

What moves: a task reads its texts once and writes them in blocks of about
``BLOCK_TOKENS`` tokens, as places in the block's sorted word hashes.  All later
steps read these blocks, so which texts a block holds is fixed.  A block sends
each of its words once, with its training count, to the bucket of the hash's
range; the bucket adds up and replies the totals in the order asked.  Its
n-grams go the same way.  The replies meet the block again, which then has
every state, arc and failure arc that its own texts can meet; nothing of the
model is collected or broadcast, no n-gram is dropped, and the model grows with
the input.  No word or n-gram is a hot key: a bucket gets it once a block.

Hashes: words are told apart by 64 bits; n-grams by a hash of ``EXTRA_BITS``
bits more than the training tokens need to be numbered, so of about 2^25
n-grams one shares its count with another.

Defined cases: null text counts as empty (one end token); a null id belongs
to the fold of the empty text; without training texts every probability is
that of the unseen token; repeated rows count and are scored each; extra
columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise

ORDER = 3
PRIOR = 3.0  # weight of the shorter history's probability, in tokens
BLOCK_TOKENS = 1_500_000
PIECE = 512  # tokens walked one after another
BUCKET_TOKENS = 1_000_000  # tokens a bucket of words or n-grams
EXTRA_BITS = 24
WORDS_HELD = 1 << 19  # word hashes a worker keeps
END = b""  # no word is empty

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """XXH64 of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def text_tokens(text: str | None) -> list[bytes]:
    """The words; the end is left to the caller."""
    return (text or "").encode().lower().split()


def _packed(a: np.ndarray) -> bytes:
    """Numbers, in as few bytes as the largest needs, with equal bytes of the elements together, compressed."""
    top = int(a.max()) if len(a) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    raw = np.ascontiguousarray(a.astype(f"<u{width}").view(np.uint8).reshape(len(a), width).T).tobytes()
    return bytes([width]) + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    if not size:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(pa.decompress(data[9:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as differences."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data).astype(np.uint64), dtype=np.uint64)


BLOCK = T.StructType([*(T.StructField(c, T.LongType()) for c in ("block", "tokens", "learned")), *(T.StructField(c, T.BinaryType()) for c in ("texts", "seq", "words", "rank", "counts"))])


def text_blocks(docs: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """The texts in blocks: ids, lengths and folds; tokens as ranks of the block's words by frequency; the words'
    sorted hashes, their ranks and their counts in training texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    limit = BLOCK_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, part, number = WordHashes(), TaskContext.get().partitionId(), 0
        end = xxhash.xxh64_intdigest(END)
        held: list[pa.RecordBatch] = []
        tokens: list[np.ndarray] = []
        lengths: list[int] = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal number, size
            head = pa.Table.from_batches(held).combine_chunks()
            learned = np.repeat(head.column("train").to_numpy(), lengths)
            words, seq, often = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            counts = np.bincount(seq[learned], minlength=len(words))
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            head = head.append_column("length", pa.array(lengths, pa.int64()))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(head)
            cells = [part << 32 | number, len(seq), int(learned.sum()), sink.getvalue().to_pybytes(), _packed(rank[seq]), _packed_keys(words), _packed(rank), _packed(counts)]
            number, size = number + 1, 0
            for x in (held, tokens, lengths):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([c], pa.int64() if i < 3 else pa.binary()) for i, c in enumerate(cells)], names=BLOCK.names)

        for batch in batches:
            begin = 0
            for i, text in enumerate(batch.column(1)):
                words = text_tokens(text.as_py())
                each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                tokens.append(np.append(each, np.uint64(end)))
                lengths.append(len(words) + 1)
                size += len(words) + 1
                if size >= limit:
                    held.append(batch.slice(begin, i + 1 - begin).select(["id", "train"]))
                    begin = i + 1
                    yield block()
            if begin < batch.num_rows:
                held.append(batch.slice(begin).select(["id", "train"]))
        if lengths:
            yield block()

    return materialise(rows.mapInArrow(run, BLOCK), "blocks")


class Block:
    """A block's texts as word numbers, and the histories and n-grams that they hold.

    Words are numbered by their sorted hashes.  ``pairs`` are the bigrams as
    word * W + word, ``triples`` the trigrams as pair * W + word, sorted."""

    def __init__(self, row: dict):
        self.words = _unpacked_keys(row["words"])
        rank = _unpacked(row["rank"]).astype(np.int64)
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        self.seq = place[_unpacked(row["seq"]).astype(np.int64)]
        self.texts = pa.ipc.open_stream(row["texts"]).read_all()
        self.lengths = self.texts.column("length").to_numpy()
        self.learned = np.repeat(self.texts.column("train").to_numpy(), self.lengths)
        self.end = int(np.searchsorted(self.words, np.uint64(xxhash.xxh64_intdigest(END))))
        starts = np.cumsum(self.lengths) - self.lengths
        before = np.empty(len(self.seq), np.int64)
        before[1:] = self.seq[:-1]
        before[starts] = self.end  # a text comes after an end
        w = len(self.words)
        self.pairs, self.pair_at = np.unique(before * w + self.seq, return_inverse=True)
        self.triples = np.zeros(0, np.int64)
        if ORDER > 2:
            first = np.zeros(len(self.seq), bool)
            first[starts] = True
            self.inner = np.flatnonzero(~first)  # tokens with two before them
            self.triples, self.triple_at = np.unique(self.pair_at[self.inner - 1] * w + self.seq[self.inner], return_inverse=True)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often training texts hold the pairs and triples."""
        pairs = np.bincount(self.pair_at[self.learned], minlength=len(self.pairs))
        if ORDER < 3:
            return pairs, np.zeros(0, np.int64)
        return pairs, np.bincount(self.triple_at[self.learned[self.inner]], minlength=len(self.triples))

    def keys(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams' hashes of ``bits`` bits, pairs first, and the order that sorts them."""
        w = len(self.words)
        mix = lambda a, b: (lambda h: (h ^ h >> np.uint64(32)) * M2)((a ^ a >> np.uint64(29)) * M1 + b)
        two = mix(self.words[self.pairs // w], self.words[self.pairs % w])
        three = mix(two[self.triples // w] + np.uint64(1), self.words[self.triples % w]) if len(self.triples) else np.zeros(0, np.uint64)
        h = np.concatenate([two, three])
        h = (h ^ h >> np.uint64(31)) >> np.uint64(64 - bits)
        return h, np.argsort(h, kind="stable")


ASKED = "bucket bigint, block bigint, keys binary, counts binary"
REPLY = "block bigint, bucket bigint, totals binary, n bigint, v bigint"


def _by_range(block: int, keys: np.ndarray, counts: np.ndarray, bits: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block's sorted keys and counts, cut at the buckets' ranges."""
    limits = np.array([min((b << bits) // buckets, (1 << 64) - 1) for b in range(1, buckets)], np.uint64)
    cuts = [0, *np.searchsorted(keys, limits).tolist(), len(keys)]
    for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
        if x < y:
            cells = [b, block, _packed_keys(keys[x:y]), _packed(counts[x:y])]
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "block", "keys", "counts"])


def _totals(asked: DataFrame) -> DataFrame:
    """Each bucket's replies, in the order of the keys asked; and, once a bucket, the sum of counts and the keys that count."""

    def total(rows: pa.Table) -> pa.Table:
        keys = [_unpacked_keys(k) for k in rows.column("keys").to_pylist()]
        counts = [_unpacked(c).astype(np.int64) for c in rows.column("counts").to_pylist()]
        sizes = [len(k) for k in keys]
        merged = np.concatenate(keys)
        del keys
        order = np.argsort(merged, kind="stable")
        ranked = merged[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        del merged, ranked
        sums = np.add.reduceat(np.concatenate(counts)[order], first)
        out = np.empty(len(order), np.int64)
        out[order] = np.repeat(sums, np.diff(np.append(first, len(order))))
        packed = [_packed(x) for x in np.split(out, np.cumsum(sizes)[:-1])]
        n = [int(sums.sum()), *[0] * (len(packed) - 1)]
        v = [int(np.count_nonzero(sums)), *[0] * (len(packed) - 1)]
        return pa.table([rows.column("block"), rows.column("bucket"), pa.array(packed, pa.binary()), pa.array(n, pa.int64()), pa.array(v, pa.int64())], names=["block", "bucket", "totals", "n", "v"])

    return asked.groupBy("bucket").applyInArrow(total, REPLY)


def word_totals(blocks: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _by_range(row["block"], _unpacked_keys(row["words"]), _unpacked(row["counts"]), 64, buckets)

    return _totals(blocks.select("block", "words", "counts").mapInArrow(send, ASKED))


def gram_totals(blocks: DataFrame, buckets: int, bits: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row)
                keys, order = block.keys(bits)
                counts = np.concatenate(block.counts())
                del block
                yield from _by_range(row["block"], keys[order], counts[order], bits, buckets)

    return _totals(blocks.mapInArrow(send, ASKED))


class Automaton:
    """States, arcs and failure arcs that a block's texts can meet; probabilities as log10.

    States: 0 is the root, then a state per word, then one per pair.  Arcs lie
    sorted by ``state * W + word`` in ``arc``, with ``weight`` and ``next``;
    ``fail`` and ``fail_weight`` belong to states.  What training texts do not
    hold has no state and no arc."""

    def __init__(self, block: Block, words: np.ndarray, grams: np.ndarray, n: int, v: int):
        w = self.w = len(block.words)
        self.base = np.log10((words + 0.5) / (n + 0.5 * (v + 1)))
        pairs, triples = grams[: len(block.pairs)], grams[len(block.pairs) :]
        history, last = block.pairs // w, block.pairs % w
        p1 = 10.0**self.base
        seen = words[history]
        p2 = (pairs + PRIOR * p1[last]) / (seen + PRIOR)
        state = np.where(pairs > 0, 1 + w + np.arange(len(pairs)), np.where(words[last] > 0, 1 + last, 0))
        kept = pairs > 0
        arcs, weights, nexts = [(1 + history[kept]) * w + last[kept]], [np.log10(p2[kept])], [state[kept] if ORDER > 2 else 1 + last[kept]]
        if len(triples):
            of, word = block.triples // w, block.triples % w
            kept = triples > 0
            of, word = of[kept], word[kept]
            shorter = np.searchsorted(block.pairs, last[of] * w + word)
            p3 = (triples[kept] + PRIOR * p2[shorter]) / (pairs[of] + PRIOR)
            arcs.append((1 + w + of) * w + word)
            weights.append(np.log10(p3))
            nexts.append(state[shorter])
        self.arc, self.weight, self.next = (np.concatenate(x) for x in ([*arcs, [np.iinfo(np.int64).max]], weights, nexts))  # the last key is no arc
        self.known = words > 0
        self.fail = np.concatenate([[0], np.zeros(w, np.int64), np.where(words[last] > 0, 1 + last, 0)])
        self.fail_weight = np.log10(PRIOR / (np.concatenate([[0], words, pairs]) + PRIOR))
        self.start = 1 + block.end if words[block.end] > 0 else 0

    def step(self, states: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text's next token, and the state behind it."""
        out, behind = np.zeros(len(states)), np.empty(len(states), np.int64)
        open_ = np.arange(len(states))
        while True:
            s, t = states[open_], tokens[open_]
            at_root = s == 0
            if at_root.any():
                here = open_[at_root]
                word = t[at_root]
                out[here] += self.base[word]
                behind[here] = np.where(self.known[word], 1 + word, 0)
                open_, s, t = open_[~at_root], s[~at_root], t[~at_root]
            if not len(open_):
                return out, behind
            key = s * self.w + t
            at = np.searchsorted(self.arc, key)
            hit = self.arc[at] == key
            here = open_[hit]
            out[here] += self.weight[at[hit]]
            behind[here] = self.next[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out, behind
            failed = states[open_]
            out[open_] += self.fail_weight[failed]
            states = states.copy()
            states[open_] = self.fail[failed]

    def scores(self, seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The texts' log-probabilities.

        All texts walk from left to right side by side, long ones in pieces of ``PIECE`` tokens: a state depends on the
        last ``ORDER - 1`` tokens alone, so a piece that starts at the root that many tokens earlier is in the text's
        own state when it begins to count.  Longest first, so those still walking are the first ones."""
        pieces = -(-lengths // PIECE)
        text = np.repeat(np.arange(len(lengths)), pieces)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
        early = np.minimum(ORDER - 1, begin)
        steps = np.minimum(PIECE, lengths[text] - begin) + early
        order = np.argsort(-steps, kind="stable")
        text, early, steps = text[order], early[order], steps[order]
        starts = (np.cumsum(lengths) - lengths)[text] + begin[order] - early
        states = np.where(early > 0, 0, self.start)
        walking = np.searchsorted(-steps, -np.arange(int(steps.max(initial=0))), side="left")
        totals = np.zeros(len(text))
        for place, active in enumerate(walking.tolist()):
            gained, states = self.step(states[:active], seq[starts[:active] + place])
            totals[:active] += np.where(early[:active] <= place, gained, 0.0)
        return np.bincount(text, totals, len(lengths))


SCORES = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score.

    ``train``: whether a row's text is learned from."""
    blocks = text_blocks(docs, train, id_col, text_col)
    all_tokens, learned = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0))).first()
    buckets = max(1, -(-all_tokens // BUCKET_TOKENS))
    bits = min(64, max(1, learned).bit_length() + EXTRA_BITS)
    words = materialise(word_totals(blocks, buckets), "word-totals")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    grams = gram_totals(blocks, buckets, bits)
    replies = words.select("block", "bucket", "totals", F.lit(False).alias("is_gram")).unionByName(grams.select("block", "bucket", "totals", F.lit(True).alias("is_gram")))
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(c, t) for c, t in SCORES)])

    def score(rows: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        replies = replies.sort_by("bucket")
        grams = replies.column("is_gram").to_numpy()
        told = replies.column("totals").to_pylist()
        for row in rows.to_pylist():
            block = Block(row)
            totals = [np.concatenate([np.zeros(0, np.int64), *(_unpacked(t).astype(np.int64) for t, g in zip(told, grams) if g == kind)]) for kind in (False, True)]
            _, order = block.keys(bits)
            by_gram = np.empty(len(order), np.int64)
            by_gram[order] = totals[1]
            automaton = Automaton(block, totals[0], by_gram, n, v)
            starts = np.cumsum(block.lengths) - block.lengths
            base = np.add.reduceat(automaton.base[block.seq], starts)
            known = np.add.reduceat(automaton.known[block.seq].astype(np.int64), starts)
            total = automaton.scores(block.seq, block.lengths)
            cells = [block.texts.column("id").cast(id_type), pa.array(block.lengths), pa.array(known), pa.array(np.full(len(known), n, np.int64)), pa.array(base), pa.array(total)]
            out.append(pa.table(cells, names=schema.names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], id_type), *(pa.array([], pa.float64() if t == T.DoubleType() else pa.int64()) for _, t in SCORES)], names=schema.names)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, schema)
