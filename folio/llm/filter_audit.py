"""Filter interaction audit with wide packed counters.

Every order of a chain of filters is audited at once.  A document is its mask
of failed filters (one bit a filter).  A mask stands for a big integer with a
field of ``WIDTH`` bits for each step of each order and each thing counted
there: the document is removed, it fails again after it was removed, a good
one is lost, a toxic one is lost.  The integers of a task's documents are
added up by part, the tasks' sums by part again, and the total is unpacked at
the end: one addition counts a document in all its orders and steps.  A field
counts at most all documents and holds 2^64 of them, so none runs over into
its neighbour.

Tasks add up in two steps (``SLOTS`` sums a part, then one), each streaming
over rows sorted by part, so neither a part that holds most documents nor a
great number of parts needs memory.

Defined cases: null text counts as empty; a null part is the empty string; a
row without an id has no smaller id, so it is no copy, and has no labels;
rows that repeat an id and text are not copies of each other; several labels
of an id count if any of them says so, null labels say nothing; extra columns
are dropped; an empty table has no parts, so no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

WIDTH = 64  # bits of a field
SLOTS = 32  # sums of a part before the last one
COUNTED = ("removed", "redundant", "good_lost", "toxic_lost")

UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"


def text_mask(text: str | None) -> int:
    """Bits 0 to 3: under 200 words; distinct words under half; over 3 % capitals; holds a mark."""
    data = (text or "").encode()
    words = data.split()
    short = len(words) < 200
    repeated = 100 * len(set(words)) < 50 * len(words)
    loud = 100 * (len(data) - len(data.translate(None, UPPER))) > 3 * len(text or "")
    marked = len(data.translate(None, MARKS)) < len(data)
    return short | repeated << 1 | loud << 2 | marked << 3


class Packed:
    """The fields of all orders of ``n`` filters, and what a mask adds to them."""

    def __init__(self, n: int):
        self.n = n
        self.orders = list(permutations(range(n)))
        self.steps = len(self.orders) * n
        self.fields = len(COUNTED) * self.steps + n + 1  # and each filter's unique failures, and all documents
        self.words = [self._word(mask, good, toxic) for mask in range(1 << n) for good in (0, 1) for toxic in (0, 1)]

    def _word(self, mask: int, good: int, toxic: int) -> int:
        fields = np.zeros(self.fields, "<u8")
        for i, order in enumerate(self.orders):
            failed = [k for k, f in enumerate(order) if mask >> f & 1]
            if failed:
                first = i * self.n + failed[0]
                fields[first] = 1
                fields[[self.steps + i * self.n + k for k in failed[1:]]] = 1
                fields[2 * self.steps + first], fields[3 * self.steps + first] = good, toxic
        if mask.bit_count() == 1:
            fields[len(COUNTED) * self.steps + mask.bit_length() - 1] = 1
        fields[-1] = 1
        return int.from_bytes(fields.tobytes(), "little")

    def pack(self, total: int) -> bytes:
        return total.to_bytes(self.fields * WIDTH // 8, "little")

    def unpack(self, data: bytes) -> dict[str, np.ndarray]:
        """Arrays (order, step) of what is counted; ``unique`` by filter; ``all``."""
        fields = np.frombuffer(data, "<u8").astype(np.int64)
        out = {c: fields[i * self.steps : (i + 1) * self.steps].reshape(-1, self.n) for i, c in enumerate(COUNTED)}
        return out | {"unique": fields[len(COUNTED) * self.steps : -1], "all": fields[-1]}


def masked_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", mask_of: Callable[[str | None], int] = text_mask, copy_bit: int = 4) -> DataFrame:
    """``part, mask, good, toxic`` of every document.

    ``mask_of`` gives the bits that a text decides alone; ``copy_bit`` is set
    where a smaller id has the same text.  The least id of a text is
    aggregated on the map side and joined back, so copies that hold a third
    of all rows meet in a join that adaptive execution splits.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = pa.array([mask_of(t.as_py()) for t in b.column(2)], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), masks, b.column(3)], names=["id", "part", "mask", "digest"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = materialise(rows.mapInArrow(run, f"id {id_type}, part string, mask int, digest binary"), "masks")
    several = rows.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "least")
    several = materialise(several, "copies")  # a join of two written tables, whose large partitions can be split
    says = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c)
    said = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(says("quality"), says("toxic"))
    is_copy = F.coalesce((F.col("id") > F.col("least")).cast("int"), F.lit(0))
    flag = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = rows.join(several, "digest", "left").join(said, "id", "left")
    return out.select("part", F.col("mask").bitwiseOR(F.shiftleft(is_copy, copy_bit)).alias("mask"), flag("quality").alias("good"), flag("toxic").alias("toxic"))


def _added(rows: Iterator[tuple[tuple, int]], packed: Packed) -> Iterator[tuple[tuple, bytes]]:
    """Sums of neighbours with the same key."""
    now, total = None, 0
    for key, value in rows:
        if key != now:
            if now is not None:
                yield now, packed.pack(total)
            now, total = key, 0
        total += value
    if now is not None:
        yield now, packed.pack(total)


def audit(masked: DataFrame, names: str) -> DataFrame:
    """For each part, order of the filters (a letter of ``names`` each, by bit) and step: what the step keeps,
    removes and loses, as ``op13``'s columns name them."""
    n = len(names)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, sums = Packed(n), defaultdict(int)

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([packed.pack(t) for t in sums.values()], pa.binary())], names=["part", "total"])
            sums.clear()
            return out

        for b in batches:
            parts = b.column(0).dictionary_encode()
            mask, good, toxic = (b.column(k).to_numpy() for k in (1, 2, 3))
            cell = parts.indices.to_numpy().astype(np.int64) << n + 2 | mask << 2 | good << 1 | toxic
            for c, times in zip(*(x.tolist() for x in np.unique(cell, return_counts=True))):
                sums[parts.dictionary[c >> n + 2].as_py()] += times * packed.words[c & (1 << n + 2) - 1]
            if len(sums) > 1000:  # parts
                yield sent()
        if sums:
            yield sent()

    def added(columns: list[str]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packed = Packed(n)
            rows = ((tuple(key), int.from_bytes(total, "little")) for b in batches for *key, total in zip(*(b.column(c).to_pylist() for c in (*columns, "total"))))
            for key, total in _added(rows, packed):
                yield pa.RecordBatch.from_arrays([*(pa.array([k]) for k in key), pa.array([total], pa.binary())], names=[*columns, "total"])

        return run

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = Packed(n)
        order = np.array(packed.orders)
        letters = np.repeat(["".join(names[f] for f in o) for o in packed.orders], n)
        step = np.tile(np.arange(1, n + 1, dtype=np.int32), len(packed.orders))
        for b in batches:
            for part, total in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = packed.unpack(total)
                by_filter = np.array([x["removed"][order == f].sum() for f in range(n)])
                columns = [x["all"] - x["removed"].cumsum(axis=1), x["removed"], x["redundant"], x["unique"][order], x["good_lost"], x["toxic_lost"], by_filter[order]]
                yield pa.RecordBatch.from_arrays([pa.array([part] * packed.steps), pa.array(letters), pa.array(step), *(pa.array(c.ravel()) for c in columns)], names=AUDIT_COLUMNS)

    task = masked.mapInArrow(words, "part string, total binary").withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS)).cast("long"))
    by_slot = task.repartition("part", "slot").sortWithinPartitions("part", "slot").mapInArrow(added(["part", "slot"]), "part string, slot bigint, total binary")
    by_part = by_slot.select("part", "total").repartition("part").sortWithinPartitions("part").mapInArrow(added(["part"]), "part string, total binary")
    return by_part.mapInArrow(unpacked, AUDIT_SCHEMA)


AUDIT_COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
AUDIT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in AUDIT_COLUMNS[3:])

