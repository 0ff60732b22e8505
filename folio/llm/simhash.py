"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits: bit k is 1 if it is set in over half the XXH64
hashes of the text's word shingles.  Texts link at a Hamming distance of at
most ``BITS``.

Candidates: the 64 bits form a ring of ``BITS + 1`` segments.  If two
fingerprints differ in at most BITS bits, then from some segment on every
chain of l consecutive segments differs in at most l * BITS / (BITS + 1)
bits: none in the first, one in the first two, and so on.  The first two
budgets make the keys: the first segment and the second with one of its bits
left out, for each start and each left-out bit, so fingerprints within the
budgets share a key.  Fingerprints that share a key are pruned by the longer
chains' budgets before the full check of all bits.

Copies meet first: only distinct fingerprints get keys.  Within a key, links
are found breadth first from a fingerprint to those not reached yet, so a
group gives fewer links than it has members.  Keys of very many fingerprints
are split once more by segments of the remaining bits (of BITS + 1 such
segments one is equal in any linked pair), which loses no link.

Defined cases: null and empty texts, and texts without words, have
fingerprint 0 and link like any other; rows that repeat an id keep it; a
component of null ids has a null id; an empty table gives an empty result;
extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise
from .components import component_roots

SHINGLE, BITS, SEED = 4, 4, 42
HOT = 4096  # fingerprints under one chain from which it is split
BLOCK = 1 << 16  # shingles hashed at once


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint, unsigned; words are parted by ASCII white space, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    begins = [0, *ends[: n - 1].tolist()]
    stops = (ends[len(words) - n :] - 1).tolist()
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = np.fromiter([digest(line[a:b], SEED) for a, b in zip(begins[at : at + BLOCK], stops[at : at + BLOCK])], np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, digest: bool = False) -> DataFrame:
    """``id, fp``: the fingerprint as a signed long; ``digest``: and ``sha256`` of the text (null: empty)."""
    more = ["sha256"] if digest else []
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType()), *(T.StructField(c, T.StringType()) for c in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=schema.names)

    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    return docs.select(F.col(id_col), F.col(text_col), *[sha.alias(c) for c in more]).mapInArrow(run, schema)


def segments(bits: int = BITS) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ring's segments."""
    n = bits + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(parts: list[tuple[int, int]]) -> int:
    return sum(((1 << w) - 1) << a for a, w in parts)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chain_keys(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """``fp, key``: for each start and left-out bit, the bits of the chain of two segments."""
    ring = segments(bits)
    n = len(ring)
    if bits == 0:
        return distinct.select("fp", F.col("fp").alias("key"))
    masks = [(start, _signed(_mask([ring[start], ring[(start + 1) % n]]) & ~(1 << out))) for start in range(n) for out in range(ring[(start + 1) % n][0], sum(ring[(start + 1) % n]))]
    whole = [(start, _signed(_mask([ring[start], ring[(start + 1) % n]]))) for start in range(n)]
    pairs = lambda ms: F.explode(F.array(*[F.struct(F.lit(s).alias("start"), F.lit(m).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for s, m in ms])).alias("c")
    # chains of very many fingerprints, as their masked keys
    chains = distinct.select(pairs(whole)).select("c.start", "c.value").groupBy("start", "value").count().filter(F.col("count") > HOT)
    near = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(m).alias("mask"), F.col("value").bitwiseAND(F.lit(m)).alias("masked")) for s, m in masks])).alias("h")
    hot = materialise(chains.select("start", near).filter("h.s = start").select("h.mask", F.col("h.masked").alias("value")).distinct(), "hot-chains")
    rows = distinct.select("fp", pairs(masks)).select("fp", "c.start", "c.mask", "c.value")
    rows = rows.join(hot.withColumn("is_hot", F.lit(True)), ["mask", "value"], "left")
    subs = []
    for start in range(n):
        rest = [b for k in range(2, n) for b in range(ring[(start + k) % n][0], sum(ring[(start + k) % n]))] or [0]
        cuts = [len(rest) * i // n for i in range(n + 1)]
        subs.append(F.array(*[F.lit(_signed(sum(1 << b for b in rest[x:y]))) for x, y in zip(cuts, cuts[1:])]))
    sub = F.when(F.col("is_hot"), F.element_at(F.array(*subs), F.col("start") + 1)).otherwise(F.array(F.lit(0).cast("long")))
    return rows.select("fp", "mask", "value", F.explode(sub).alias("more")).select("fp", F.xxhash64("mask", "value", "more", F.col("fp").bitwiseAND(F.col("more"))).alias("key"))


def _within(fps: np.ndarray, one: np.uint64, masks: list[list[np.uint64]], bits: int) -> np.ndarray:
    """Which of ``fps`` link to ``one``: chain budgets first, then all bits."""
    diff = fps ^ one
    ok = np.zeros(len(fps), bool)
    for chain in masks:
        alive = np.arange(len(fps))
        for length, mask in enumerate(chain, 1):
            alive = alive[np.bitwise_count(diff[alive] & mask) <= length * bits // (bits + 1)]
            if not len(alive):
                break
        ok[alive] = True
    ok[ok] = np.bitwise_count(diff[ok]) <= bits
    return ok


def forest(fps: np.ndarray, masks: list[list[np.uint64]], bits: int) -> list[tuple[int, int]]:
    """Links that connect what is within ``bits`` of each other, fewer than there are fingerprints."""
    links, waiting = [], fps
    while len(waiting) > 1:
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            one = queue.pop()
            near = _within(waiting, one, masks, bits)
            if near.any():
                found = waiting[near]
                links += [(int(one), int(x)) for x in found]
                queue += list(found)
                waiting = waiting[~near]
    return links


def near_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, b``: fingerprint pairs within ``bits`` that connect all such pairs of the table."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    ring = segments(bits)
    chains = [[np.uint64(_mask([ring[(s + k) % len(ring)] for k in range(length)])) for length in range(1, len(ring))] for s in range(len(ring))] or [[]]

    def links(keys: np.ndarray, fps: np.ndarray) -> np.ndarray:
        cuts = np.flatnonzero(np.diff(keys)) + 1
        begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
        out: list[tuple[int, int]] = []
        sizes = ends - begins
        pairs = begins[sizes == 2]  # most keys: no need to walk
        if len(pairs):
            near = pairs[np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= bits]
            out += zip(fps[near].tolist(), fps[near + 1].tolist())
        for a, b in zip(begins[sizes > 2], ends[sizes > 2]):
            out += forest(fps[a:b], chains, bits)
        return np.array(out, np.uint64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

        def done(k, f):
            found = np.unique(links(k, f), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(1).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            last = np.searchsorted(keys, keys[-1])  # the last key may go on
            if last:
                yield done(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield done(keys, fps)

    keyed = chain_keys(distinct, bits)
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS, digest: bool = False) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the component's smallest id);
    ``digest``: and ``sha256`` of the text, and ``root``, which tells components apart that have the same id."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle, digest), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min(id_col).alias("first_id")), "distinct")
    roots = materialise(component_roots(near_links(distinct.select("fp"), bits)), "roots")
    rooted = materialise(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    named = materialise(rooted.join(least, "root").select("fp", "component_id", "root"), "named")
    return rows.join(named, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *(["sha256", "root"] if digest else []))
