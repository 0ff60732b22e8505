"""Exact de-duplication over cuckoo-filter indexes of live digests.

The digest of a text is its SHA-256 with its byte length.  Digests are dealt
to shards by hash; a shard's index is a cuckoo filter (buckets of four 16-bit
fingerprints, two candidate buckets each) whose slots also store the full
digest and a value.  A filter hit counts only after the stored digest has
been compared; an insertion that finds no place after a bounded number of
evictions doubles the table and rebuilds it from the stored digests.

``exact_groups`` finds the groups of equal texts of a table;
``apply_changes`` keeps a stored index up to date with insertions and
deletions.

Defined cases: a null text counts as empty; a null id never wins over
another id, and a group of null ids has a null keeper; rows that repeat an id
and its text count in the group and share its verdict; an empty table gives
an empty result; extra columns are dropped.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

SLOTS = 4
KICKS = 500
SHARD_KEYS = 8192  # expected digests a shard
SALTS = 256  # a text's copies are counted in so many parts before they meet


class CuckooIndex:
    """Cuckoo filter over digests, with the digests and a value stored beside the slots."""

    def __init__(self, buckets: int = 64):
        self.count = 0
        self._allot(buckets)

    def _allot(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))  # 0: empty
        self.digests: list[bytes | None] = [None] * (SLOTS * buckets)
        self.values: list = [None] * (SLOTS * buckets)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") % 65535 + 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _find(self, digest: bytes) -> int:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.marks[slot] == mark and self.digests[slot] == digest:  # the filter's hit is verified
                    return slot
        return -1

    def get(self, digest: bytes, default=None):
        slot = self._find(digest)
        return default if slot < 0 else self.values[slot]

    def set(self, digest: bytes, value) -> None:
        """Replace the value of a live digest."""
        self.values[self._find(digest)] = value

    def delete(self, digest: bytes) -> bool:
        slot = self._find(digest)
        if slot < 0:
            return False
        self.marks[slot], self.digests[slot], self.values[slot] = 0, None, None
        self.count -= 1
        return True

    def insert(self, digest: bytes, value) -> None:
        """Add a digest that is not live."""
        self.count += 1
        left = self._place(digest, value)
        if left is not None:
            self._grow([*self.items(), left])

    def _grow(self, stored: list[tuple[bytes, object]]) -> None:
        while True:
            self._allot(2 * (self.mask + 1))
            if all(self._place(*item) is None for item in stored):
                return

    def _place(self, digest: bytes, value) -> tuple[bytes, object] | None:
        """None, or the entry that found no place."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.digests[slot], self.values[slot] = mark, digest, value
                    return None
        bucket = second
        for kick in range(KICKS):
            slot = SLOTS * bucket + kick % SLOTS
            self.marks[slot], mark = mark, self.marks[slot]
            self.digests[slot], digest = digest, self.digests[slot]
            self.values[slot], value = value, self.values[slot]
            bucket = self._other(bucket, mark)
            for free in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if not self.marks[free]:
                    self.marks[free], self.digests[free], self.values[free] = mark, digest, value
                    return None
        return digest, value

    def items(self):
        for digest, value in zip(self.digests, self.values):
            if digest is not None:
                yield digest, value


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_sha256, n_bytes`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).cast("long").alias("n_bytes"))


def _digest(sha256: str, n_bytes: int) -> bytes:
    return bytes.fromhex(sha256) + n_bytes.to_bytes(8, "little")


def _larger(a, b):
    return b if a is None or (b is not None and b > a) else a


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Copies are counted before they move: every (digest, salt) is one row when
    it reaches its shard, and the verdict returns to the same (digest, salt).
    """
    salted = text_digests(docs, id_col, text_col).withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
    rows = materialise(salted, "digests")  # texts are read once
    keys = ["text_sha256", "n_bytes", "salt"]
    parts = rows.groupBy(*keys).agg(F.max(id_col).alias("best"), F.count(F.lit(1)).alias("n"))
    shards = max(1, -(-rows.count() // SHARD_KEYS))
    schema = T.StructType([*(T.StructField(k, parts.schema[k].dataType) for k in keys), T.StructField("keep_id", docs.schema[id_col].dataType), T.StructField("group_size", T.LongType())])

    def judge(t: pa.Table) -> pa.Table:
        digests = [_digest(s, n) for s, n in zip(t.column("text_sha256").to_pylist(), t.column("n_bytes").to_pylist())]
        index = CuckooIndex()
        for digest, best, n in zip(digests, t.column("best").to_pylist(), t.column("n").to_pylist()):
            live = index.get(digest)
            if live is None:
                index.insert(digest, (best, n))
            else:  # the largest id stays live
                index.set(digest, (_larger(live[0], best), live[1] + n))
        found = [index.get(d) for d in digests]
        return t.select(keys).append_column("keep_id", pa.array([f[0] for f in found], t.column("best").type)).append_column("group_size", pa.array([f[1] for f in found], pa.int64()))

    verdicts = parts.withColumn("shard", F.pmod(F.xxhash64("text_sha256"), F.lit(shards))).groupBy("shard").applyInArrow(judge, schema)
    return rows.join(verdicts, keys).select(id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def apply_changes(index: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """A stored index after a batch of changes, in the order of ``seq``.

    ``index``: text_sha256, n_bytes, live_id; ``changes``: the same columns
    with ``seq`` (long) and ``op``, ``insert`` or ``delete``.  Inserting a
    live digest keeps the larger id; deleting one that is not live does
    nothing; other ops are ignored.
    """
    shard = F.pmod(F.xxhash64("text_sha256"), F.lit(shards)).alias("shard")
    cols = ["text_sha256", "n_bytes", "live_id"]
    schema = T.StructType([T.StructField(c, index.schema[c].dataType) for c in cols])

    def merge(old: pa.Table, new: pa.Table) -> pa.Table:
        live = CuckooIndex()
        for s, n, i in zip(*(old.column(c).to_pylist() for c in cols)):
            live.insert(_digest(s, n), i)
        order = new.sort_by("seq")
        for s, n, i, op in zip(*(order.column(c).to_pylist() for c in [*cols, "op"])):
            digest = _digest(s, n)
            if op == "delete":
                live.delete(digest)
            elif op == "insert":
                if live._find(digest) < 0:
                    live.insert(digest, i)
                else:
                    live.set(digest, _larger(live.get(digest), i))
        out = list(live.items())
        return pa.table([pa.array([d[:32].hex() for d, _ in out], pa.string()), pa.array([int.from_bytes(d[32:], "little") for d, _ in out], pa.int64()), pa.array([v for _, v in out], old.column("live_id").type)], names=cols)

    return index.select(*cols, shard).groupBy("shard").cogroup(changes.select(*cols, "seq", "op", shard).groupBy("shard")).applyInArrow(merge, schema)
