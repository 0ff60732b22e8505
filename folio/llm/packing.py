"""Packing of documents into fixed windows by minimum bin slack.

Each document's ids are cut at multiples of the window; full pieces are
windows of their own and never move.  The remainders are dealt by hash to
shards of bounded size.  In a shard, the remaining lengths form a multiset:
every window starts with the longest one left, and a subset-sum dynamic
program over bit sets (a bounded count of a length enters in powers of two)
finds the multiset of other lengths that fills the window closest to its
capacity; the counts come from backtracking through the stored bit sets.

Defined cases: null text counts as empty (its one id is the closing id);
repeated rows are packed each; an empty table gives an empty result; extra
columns are dropped.  Ties between equal lengths go to the smaller
(id, start).
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import tokenizer
from .common import materialise

WINDOW = 2048
SHARD_ROWS = 4000  # expected remainders a shard: bounds a task's memory and the plan's work


def closest_fill(lengths: list[int], counts: dict[int, int], target: int) -> dict[int, int]:
    """Counts by length of a sub-multiset whose sum is the largest one not above ``target``.

    ``lengths``: the distinct lengths in ascending order.  Longer lengths come
    first, and the program stops once the target itself is reachable.
    """
    goal, limit = 1 << target, (1 << (target + 1)) - 1
    sums, steps = 1, []
    for i in range(bisect_right(lengths, target) - 1, -1, -1):
        length = lengths[i]
        left, unit = min(counts[length], target // length), 1
        while left > 0:
            unit = min(unit, left)
            steps.append((length, unit, sums))
            sums |= (sums << (length * unit)) & limit
            left -= unit
            unit *= 2
        if sums & goal:
            break
    at, used = sums.bit_length() - 1, {}
    for length, unit, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + unit
            at -= length * unit
    return used


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> Iterator[tuple[dict[int, int], int]]:
    """(counts by length, how many windows are filled that way), until ``counts`` is used up."""
    lengths = sorted(counts)
    while lengths:
        longest = lengths[-1]
        counts[longest] -= 1
        pattern = closest_fill(lengths if counts[longest] else lengths[:-1], counts, window - longest) if longest < window else {}
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            counts[k] -= n * times
            if not counts[k]:
                lengths.remove(k)
        yield pattern, times


PIECE = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType())]


def token_pieces(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 1, with_ids: bool = False, chunks: int | None = None) -> DataFrame:
    """One row per piece of at most ``window`` ids; ``full_id`` numbers the full ones (null for the rest)."""
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, t) for n, t in PIECE)]
        + ([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else [])
        + [T.StructField("full_id", T.LongType())]
    )
    id_kind = pa.int64() if isinstance(docs.schema[id_col].dataType, T.LongType) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, close = tokenizer(vocab_path, "library", chunks), array("I", [end_id]).tobytes()
        full = TaskContext.get().partitionId() << 40  # each task numbers its own
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.encode(text.as_py()) + close
                n = len(ids) // 4
                for at in range(0, n, window):
                    piece = ids[4 * at : 4 * (at + window)]
                    whole = len(piece) == 4 * window
                    rows.append((doc, at, len(piece) // 4, zlib.crc32(piece), n, *((array("I", piece).tolist(),) if with_ids else ()), full if whole else None))
                    full += whole
            cols = list(zip(*rows)) or [()] * len(schema)
            kinds = [id_kind or batch.column(0).type, *[pa.int64()] * 4, *([pa.list_(pa.int64())] if with_ids else []), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 1, with_ids: bool = False, shards: int | None = None, chunks: int | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset.

    Sequence ids are negative for full pieces (numbered by task) and
    non-negative for planned windows (numbered by shard).  ``shards`` defaults
    to one for every ``SHARD_ROWS`` remainders.  ``chunks``: words that a
    worker's cache keeps a generation, some 230 bytes each.
    """
    found = token_pieces(docs, vocab_path, id_col, text_col, window, end_id, with_ids, chunks).withColumn("__place", F.monotonically_increasing_id())
    pieces = materialise(found, "pieces")  # read twice, encoded once; the places are fixed, so that equal rows can be dealt apart
    shards = shards or max(1, -(-pieces.filter("full_id IS NULL").count() // SHARD_ROWS))
    kept = [c for c in pieces.columns if c not in ("full_id", "__place")]
    full = pieces.filter("full_id IS NOT NULL").select(
        *kept, (-F.col("full_id") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.filter("full_id IS NULL").select(*kept, F.pmod(F.xxhash64("__place"), F.lit(shards)).alias("shard"))
    schema = T.StructType([pieces.schema[c] for c in kept] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def plan(piece_rows: pa.Table) -> pa.Table:
        shard = piece_rows.column("shard")[0].as_py()
        t = piece_rows.drop_columns(["shard"]).sort_by([(id_col, "descending"), ("start", "descending")])
        by_length: dict[int, list[int]] = {}
        for row, length in enumerate(t.column("length").to_pylist()):
            by_length.setdefault(length, []).append(row)
        sequence, offset = [0] * len(t), [0] * len(t)
        window_id = shard << 24
        for pattern, times in plan_windows({k: len(v) for k, v in by_length.items()}, window):
            for _ in range(times):
                at = 0
                for length, n in sorted(pattern.items(), reverse=True):
                    for _ in range(n):
                        row = by_length[length].pop()
                        sequence[row], offset[row] = window_id, at
                        at += length
                window_id += 1
        return t.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return full.unionByName(rest.groupBy("shard").applyInArrow(plan, schema))


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids``: the windows of a packing made ``with_ids``, padded to ``window``
    unless their length is a power of two."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    n = F.size("ids")
    pad = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(F.lit(window) - n)
    return parts.select("sequence_id", ids.alias("ids")).select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id).cast("long"), pad)).alias("ids"))
