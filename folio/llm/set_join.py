"""N-gram Jaccard join, size-aware: subsets for light sets, inverted lists for heavy ones.

A text is the set of its word shingles, as 64-bit hashes.  Two texts link if
their sets' Jaccard similarity is at least ``SIMILARITY`` per cent.  Of a set
of n shingles a partner holds at least c = ceil(similarity * n), so of the
p = n - c + 1 rarest shingles of both sets one is common, and of the p + 1
rarest two are (one order for all: common shingles last, by an estimate of
their frequency, the others by hash).

* Light sets: all subsets of two of the p + 1 rarest shingles are keys, and
  light sets that share a key are candidates.
* Heavy sets scan the inverted lists of their p rarest shingles.  Light sets
  that are large enough for a heavy partner are in those lists too.
* The boundary between them is where the sum of both costs over the table's
  sizes is least: C(p + 1, 2) keys a light set, p list entries and as many
  candidates as the lists are long a heavy one.

Copies of a set meet first, so only different sets are joined.  Keys of at
most ``SMALL`` sets give all their pairs.  Larger ones give a forest: in parts
of at most about ``HOT`` sets, links that connect what may link, found breadth
first.  Once these are verified, only sets of different components can still
add anything; of those in one key, all that are not in its largest component
meet all others (first their nearest, then every one left).  No pair of a key
goes unseen, and none is listed whose sets are connected anyway.

Before sets are compared, pairs are pruned by size and by parity bitmaps: bit
i says whether an odd number of shingles fall on i, so two bitmaps differ in
at most as many bits as the sets in shingles; bitmaps of larger sets are
larger and fold down.  What is left is verified on whole sets.  These are made
from the texts once more, for the sets in question alone (a filter of
``FILTER_BITS`` bits, and an exact join behind it).

Defined cases: null and empty texts, and texts without words, have the empty
set, which links with nothing; fewer words than a shingle are one shingle;
rows that repeat an id keep it; the smallest id of a component does not count
null ids, and a component of null ids has a null id; an empty table gives an
empty result; extra columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, materialise
from .components import component_roots

SHINGLE, SIMILARITY = 4, 85  # words, per cent
COMMON = 1 << 16  # shingles whose frequency is estimated for the order; others count as rare
TASK_COMMON, HELD = 4096, 1 << 20  # common shingles a task passes on, and shingles it counts at once
SMALL = 8  # sets under a key that give all their pairs
HOT = 1024  # sets of a key that meet in one part
NEAREST = 4  # foreign sets a set is tried with before all others
PAIR_COST = 1.0  # of a candidate, in keys
CLASSES = 64  # prefix lengths told apart for the costs
MIN_BITS = 512  # of a parity bitmap
FILTER_BITS = 24  # as a power of two
PIECE = 1 << 18  # bytes of a text whose words are hashed at once

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes:
    """64-bit hashes of all words of a text, A-Z as a-z: polynomials of random numbers by byte, from sums over the text."""

    BASE = 0x9FB21C651E98DF25
    SPACE = re.compile(rb"[\x20\x09-\x0D]")

    def __init__(self):
        byte = np.random.default_rng(42).integers(1, 1 << 64, 256, np.uint64, endpoint=False)
        byte[65:91] = byte[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.byte, self.powers, self.inverses = byte, np.empty(0, np.uint64), np.empty(0, np.uint64)

    def _grown(self, n: int) -> None:
        size = max(1 << 12, 1 << n.bit_length())
        for name, base in (("powers", self.BASE), ("inverses", pow(self.BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def _hashed(self, piece: bytes) -> np.ndarray:
        b = np.frombuffer(piece, np.uint8)
        n = len(b)
        if n > len(self.powers):
            self._grown(n)
        edges = np.flatnonzero(np.diff(self.space[b], prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[b] * self.powers[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        h = (h ^ h >> np.uint64(31)) * M1
        return h ^ h >> np.uint64(29)

    def words(self, raw: bytes) -> np.ndarray:
        if len(raw) <= PIECE:
            return self._hashed(raw)
        found, at = [], 0
        while at < len(raw):  # cut between words
            cut = self.SPACE.search(raw, at + PIECE)
            end = cut.end() if cut else len(raw)
            found.append(self._hashed(raw[at:end]))
            at = end
        return np.concatenate(found)


def shingle_set(text: str | None, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """The text's distinct shingles as sorted hashes; words are parted by ASCII white space, A-Z lower-cased."""
    each = hashes.words((text or "").encode())
    if not len(each):
        return each
    size = min(shingle, len(each))
    n = len(each) - size + 1
    h = each[:n] + np.uint64(size)
    for k in range(1, size):
        h = (h ^ h >> np.uint64(29)) * M1 + each[k : n + k]
    h = (h ^ h >> np.uint64(32)) * M2
    h = np.sort(h ^ h >> np.uint64(29))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def least_overlap(n: int, similarity: int = SIMILARITY) -> int:
    """What any partner of a set of n shares with it."""
    return -(-similarity * n // 100)


def prefix_length(n: int, similarity: int = SIMILARITY) -> int:
    return n - least_overlap(n, similarity) + 1


def most_different(a, b, similarity: int = SIMILARITY):
    """Shingles in one set only that two linked sets of sizes a and b have at most."""
    total = a + b
    return total - 2 * -(-similarity * total // (100 + similarity))


def similar(a: np.ndarray, b: np.ndarray, similarity: int = SIMILARITY) -> bool:
    """Whether two sorted sets link."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= similarity * (len(a) + len(b) - both)


def parity(s: np.ndarray) -> bytes:
    bits = MIN_BITS
    while bits < len(s):
        bits *= 2
    counts = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold(rows: np.ndarray) -> np.ndarray:
    """Bitmaps of half the bits."""
    half = rows.shape[-1] // 2
    return rows[..., :half] ^ rows[..., half:]


class Bitmaps:
    """Parity bitmaps of some sets, by size."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes], similarity: int):
        self.sizes, self.similarity = sizes, similarity
        self.words = np.array([len(b) // 8 for b in bitmaps])
        self.levels = {w: (at := np.flatnonzero(self.words == w), np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint64).reshape(len(at), w)) for w in np.unique(self.words).tolist()}
        self.row = np.empty(len(bitmaps), np.int64)
        for at, _ in self.levels.values():
            self.row[at] = np.arange(len(at))

    def distances(self, one: int, others: np.ndarray) -> np.ndarray:
        """Of ``others`` that may link with ``one``, at least so many shingles are in one set only; -1 where they cannot link."""
        out = np.full(len(others), -1)
        size, w = int(self.sizes[one]), int(self.words[one])
        n = self.sizes[others]
        fits = 100 * np.minimum(n, size) >= self.similarity * np.maximum(n, size)
        mine = self.levels[w][1][self.row[one]]
        for level in {w // 2, w, 2 * w} & self.levels.keys():
            at = np.flatnonzero(fits & (self.words[others] == level))
            if len(at):
                rows = self.levels[level][1][self.row[others[at]]]
                diff = rows ^ mine if level == w else _fold(rows) ^ mine if level > w else rows ^ _fold(mine)
                far = np.bitwise_count(diff).sum(axis=1, dtype=np.int64)
                ok = far <= most_different(n[at], size, self.similarity)
                out[at[ok]] = far[ok]
        return out


def may_link(size_a: int, size_b: int, map_a: bytes, map_b: bytes, similarity: int = SIMILARITY) -> bool:
    a, b = np.frombuffer(map_a, np.uint64), np.frombuffer(map_b, np.uint64)
    while len(a) > len(b):
        a = _fold(a)
    while len(b) > len(a):
        b = _fold(b)
    return int(np.bitwise_count(a ^ b).sum()) <= most_different(size_a, size_b, similarity)


def read_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``id, sid, n`` of every row (sid: digest of the set), and the common shingles, sorted, with their estimates."""
    id_type = docs.schema[id_col].dataType.simpleString()

    names = ["id", "sid", "n", "shingle", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows, kind = WordHashes(), 0, None
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def add(sets: list[np.ndarray]) -> None:
            nonlocal keys, counts
            new, times = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            both, of = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(of, np.concatenate([counts, times]), len(both)).astype(np.int64)
            while len(sums) > HELD // 2:
                kept = sums > sums.min()  # an estimate: what is rare so far is forgotten
                both, sums = both[kept], sums[kept]
            keys, counts = both, sums

        for batch in batches:
            rows, kind = rows + batch.num_rows, batch.schema.field(0).type
            kept, held, sids, sizes = [], 0, [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), hashes, shingle)
                sids.append(xxhash.xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                kept.append(s)
                held += len(s)
                if held >= HELD:
                    add(kept)
                    kept, held = [], 0
            add(kept)
            nothing = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sids, pa.binary()), pa.array(sizes, pa.int64()), nothing, nothing], names=names)
        if rows:
            top = np.argsort(counts)[::-1][:TASK_COMMON]
            top = top[counts[top] >= max(4, rows // 1000)]
            k = len(top)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, kind), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()), pa.array(keys[top].view(np.int64)), pa.array(counts[top])], names=names)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    written = materialise(texts.mapInArrow(run, f"id {id_type}, sid binary, n bigint, shingle bigint, times bigint"), "shingled")
    common = written.filter("times IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shingle").limit(COMMON).toPandas()
    keys, times = common["shingle"].to_numpy(np.int64).view(np.uint64), common["times"].to_numpy(np.int64)
    order = np.argsort(keys)
    return written.filter("times IS NULL").select("id", "sid", "n"), keys[order], times[order]


def _frequencies(s: np.ndarray, keys: np.ndarray, times: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(s), np.int64)
    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
    return np.where(keys[at] == s, times[at], 0)


def distinct_sets(docs: DataFrame, text_col: str, keys: np.ndarray, times: np.ndarray, shingle: int, similarity: int) -> DataFrame:
    """``num, sid, th, n, prefix, map`` of every different set that can have partners: a number, the digest, a hash of
    a text that has the set, the size, the p + 1 rarest shingles in order, the parity bitmap."""
    sent = docs.sparkSession.sparkContext.broadcast((keys, times))  # COMMON entries at most
    names = ["sid", "th", "n", "prefix", "map"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), RecentCache(1 << 16)
        keys, times = sent.value
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for th, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(t.as_py(), hashes, shingle)
                sid = xxhash.xxh3_128_digest(s.tobytes())
                if len(s) < 2 or seen.get(sid):  # sets of one only link with equal ones; copies in a task meet here
                    continue
                seen.put(sid, True)
                f = _frequencies(s, keys, times)
                order = np.argsort(f, kind="stable") if f.any() else np.arange(len(s))
                row = (sid, th, len(s), s[order[: prefix_length(len(s), similarity) + 1]].view(np.int64), parity(s))
                for c, v in zip(out, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))], names=names)

    rows = docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).mapInArrow(run, "sid binary, th bigint, n bigint, prefix array<bigint>, map binary")
    return materialise(rows.dropDuplicates(["sid"]).withColumn("num", F.monotonically_increasing_id()), "sets")


def boundary(sets: DataFrame, similarity: int) -> int:
    """The longest prefix (p) of a light set, by cost."""
    p = F.least(F.size("prefix") - 1, F.lit(CLASSES))
    lists = sets.select(p.alias("p"), F.explode("prefix").alias("e")).groupBy("p").agg(F.count(F.lit(1)).alias("entries"), F.approx_count_distinct("e").alias("lists"))
    by_p = {r.p: r for r in lists.collect()}
    light = {k: r.entries / (k + 1) * k * (k + 1) / 2 for k, r in by_p.items()}
    heavy = {k: r.entries / (k + 1) * k * (1 + PAIR_COST * max(0.0, r.entries / max(1, r.lists) - 1)) for k, r in by_p.items()}
    cost = lambda x: sum(light[k] if k <= x else heavy[k] for k in by_p)
    return min(range(CLASSES), key=lambda x: (cost(x), x))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (np.minimum(a, b) ^ np.maximum(a, b) * M1) * M2
    return h ^ h >> np.uint64(31)


def candidates(sets: DataFrame, keys: np.ndarray, times: np.ndarray, light: int, similarity: int) -> DataFrame:
    """Pairs ``a, b`` of keys of at most ``SMALL`` sets, and ``key, num, n`` of the sets of larger keys (the other columns null)."""
    sent = sets.sparkSession.sparkContext.broadcast((keys, times))
    heavy_from = next((n for n in range(2, 100 * (light + 3)) if prefix_length(n, similarity) > light), 1 << 62)  # the smallest heavy set
    small, hot = SMALL, HOT

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                part = batch.slice(at, 256)
                for num, n, prefix in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                    e = prefix.values.to_numpy().view(np.uint64)
                    f = _frequencies(e, keys, times)
                    p = len(e) - 1
                    ways = []
                    if p <= light:
                        i, j = np.triu_indices(p + 1, 1)
                        ways.append((_mixed(e[i], e[j]), np.minimum(f[i], f[j])))
                    if p > light or 100 * n >= similarity * heavy_from:
                        ways.append((e[:p], f[:p]))
                    for key, often in ways:
                        parts = often // hot + 1  # a key that is known to be common is dealt to several tasks
                        salt = ((key ^ np.uint64(num)) * M1 >> np.uint64(40)).astype(np.int64) % parts
                        for c, v in zip(out, (key.view(np.int64), salt, np.full(len(key), num), np.full(len(key), n), parts)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *c])) for c in out], names=["key", "salt", "num", "n", "parts"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams over keys and keeps what may be a small one."""
        group, held, large = None, [], False
        pairs: tuple[list, list] = ([], [])
        rows: tuple[list, list, list] = ([], [], [])

        def sent_on() -> pa.RecordBatch:
            k, m = len(pairs[0]), len(rows[0])
            cells = [[*c, *[None] * m] for c in pairs] + [[*[None] * k, *c] for c in rows]
            for c in (*pairs, *rows):
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], names=["a", "b", "key", "num", "n"])

        def close() -> None:
            if large or len(held) < 2:
                return
            for i, (x, n) in enumerate(held):  # sizes rise
                for y, m in held[i + 1 :]:
                    if 100 * n < similarity * m:
                        break
                    if x != y:
                        pairs[0].append(min(x, y))
                        pairs[1].append(max(x, y))

        def passed(num, n) -> None:
            for c, v in zip(rows, (group[0], num, n)):
                c.append(v)

        for batch in batches:
            for key, salt, num, n, parts in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, salt) != group:
                    close()
                    group, held, large = (key, salt), [], parts > 1
                if large:
                    passed(num, n)
                elif len(held) < small:
                    held.append((num, n))
                else:
                    large = True
                    for h in (*held, (num, n)):
                        passed(*h)
            if len(pairs[0]) + len(rows[0]) > 1 << 16:
                yield sent_on()
        close()
        yield sent_on()

    rows = sets.select("num", "n", "prefix").mapInArrow(keyed, "key bigint, salt bigint, num bigint, n bigint, parts bigint")
    order = ["key", "salt", "n", "num"]
    return rows.repartition("key", "salt").sortWithinPartitions(*order).select(*order[:2], "num", "n", "parts").mapInArrow(met, "a bigint, b bigint, key bigint, num bigint, n bigint")


def pruned(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs whose parity bitmaps allow a link."""
    side = lambda c: sets.select(F.col("num").alias(c), F.col("n").alias(f"n_{c}"), F.col("map").alias(f"map_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [may_link(*r, similarity) for r in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "map_a", "map_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "n_a", "n_b", "map_a", "map_b").mapInArrow(run, "a bigint, b bigint")


def _by_part(rows: DataFrame, fn) -> DataFrame:
    """``fn(nums, sizes, bitmaps, roots, homes)`` of each part's sets gives pairs of places; streams over parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            nums, sizes, bitmaps, roots, homes = zip(*held)
            found = fn(np.array(nums), np.array(sizes), list(bitmaps), np.array(roots), np.array(homes))
            if len(found):
                ab = np.sort(np.array(nums)[np.array(found)], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

        for batch in batches:
            for key, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, part) != group:
                    if len(held) > 1:
                        yield from done()
                    group, held = (key, part), []
                held.append(row)
        if len(held) > 1:
            yield from done()

    cols = ["key", "part", "num", "n", "map", "root", "home"]
    return rows.select(*cols).repartition("key", "part").sortWithinPartitions("key", "part", "num").mapInArrow(run, "a bigint, b bigint").distinct()


def forest_pairs(members: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs that connect what may link within each part of a key."""

    def forest(nums, sizes, bitmaps, roots, homes):
        maps, found = Bitmaps(sizes, bitmaps, similarity), []
        waiting = np.arange(len(nums))
        while len(waiting) > 1:
            queue, waiting = [waiting[0]], waiting[1:]
            while queue and len(waiting):
                one = queue.pop()
                near = maps.distances(one, waiting) >= 0
                if near.any():
                    found += [(one, x) for x in waiting[near]]
                    queue += waiting[near].tolist()
                    waiting = waiting[~near]
        return found

    own = F.pmod(F.xxhash64("num"), F.col("parts"))
    mapped = members.join(sets.select("num", "map"), "num")
    return _by_part(mapped.withColumns({"part": own, "root": F.col("num"), "home": F.lit(True)}), forest)


def foreign_pairs(members: DataFrame, sets: DataFrame, roots: DataFrame, nearest: int, similarity: int) -> DataFrame:
    """Pairs of a key whose sets are in different components and may link; ``nearest``: only so many a set (0: all)."""
    named = members.join(roots.withColumnsRenamed({"node": "num"}), "num", "left").withColumn("root", F.coalesce("root", "num"))
    named = materialise(named, "named")
    sizes = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("key").agg(F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).filter("roots > 1").select("key", F.col("top.root").alias("main"))
    own = F.pmod(F.xxhash64("num"), F.col("parts"))
    # sets outside the key's largest component go to all its parts, the others to one
    where = F.when(F.col("root") == F.col("main"), F.array(own)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    open_ = materialise(named.join(main, "key"), "open")  # the keys with several components, before the bitmaps join them
    rows = open_.join(sets.select("num", "map"), "num").withColumns({"own": own, "part": F.explode(where)}).withColumn("home", F.col("own") == F.col("part"))

    def foreign(nums, sizes, bitmaps, roots, homes):
        maps, found = Bitmaps(sizes, bitmaps, similarity), []
        values, counts = np.unique(roots, return_counts=True)
        here = np.flatnonzero(homes)
        moved = np.flatnonzero(~homes | (roots != values[np.argmax(counts)]))
        for one in moved.tolist():
            others = here[roots[here] != roots[one]]
            far = maps.distances(one, others)
            ok = np.flatnonzero(far >= 0)
            if nearest and len(ok) > nearest:
                ok = ok[np.argsort(far[ok], kind="stable")[:nearest]]
            found += [(one, x) for x in others[ok].tolist()]
        return found

    return _by_part(rows, foreign)


def whole_sets(docs: DataFrame, text_col: str, sets: DataFrame, nums: DataFrame, shingle: int) -> DataFrame:
    """``num, elements`` of the numbered sets, from the texts."""
    needed = materialise(sets.join(nums, "num", "left_semi").select("num", "sid", "th"), "needed")
    bits = FILTER_BITS
    slot = F.pmod(F.col("th"), F.lit(1 << bits))
    words = needed.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, CAST(pmod(th, 64) AS INT))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("v")).toPandas()
    table = np.zeros(1 << bits - 6, np.int64)
    table[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))  # 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, table = WordHashes(), RecentCache(1 << 16), sent.value
        for batch in batches:
            th = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.mod(th, 1 << bits)
            hit = np.flatnonzero(table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            for part in np.split(hit, range(128, len(hit), 128)):
                sids, elements = [], []
                for i in part.tolist():
                    s = shingle_set(batch.column(1)[i].as_py(), hashes, shingle).tobytes()
                    sid = xxhash.xxh3_128_digest(s)
                    if not seen.get(sid):
                        seen.put(sid, True)
                        sids.append(sid)
                        elements.append(s)
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), pa.array(elements, pa.binary())], names=["sid", "elements"])

    made = docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).mapInArrow(run, "sid binary, elements binary")
    return materialise(made.join(needed.select("sid", "num"), "sid").dropDuplicates(["num"]).select("num", "elements"), "whole-sets")


def verified(pairs: DataFrame, whole: DataFrame, similarity: int) -> DataFrame:
    """The pairs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda c: whole.select(F.col("num").alias(c), F.col("elements").alias(f"set_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return materialise(joined.mapInArrow(run, "a bigint, b bigint"), "links")


def set_links(docs: DataFrame, sets: DataFrame, keys: np.ndarray, times: np.ndarray, text_col: str, shingle: int, similarity: int) -> DataFrame:
    """Links ``a, b`` between numbered sets that connect all that link."""
    found = materialise(candidates(sets, keys, times, boundary(sets, similarity), similarity), "candidates")
    members = found.filter("key IS NOT NULL").select("key", "num", "n").distinct()
    counts = members.groupBy("key").agg((F.floor((F.count(F.lit(1)) - 1) / HOT) + 1).alias("parts"))
    members = materialise(members.join(counts, "key"), "members")
    first = pruned(found.filter("a IS NOT NULL"), sets, similarity).unionByName(forest_pairs(members, sets, similarity)).distinct()
    first = materialise(first, "pairs")
    nums = first.select(F.col("a").alias("num")).union(first.select("b")).union(members.filter("parts > 1").select("num")).distinct()
    whole = whole_sets(docs, text_col, sets, nums, shingle)
    links, tried = verified(first, whole, similarity), first
    if members.isEmpty():
        return links
    for nearest in (NEAREST, 0):
        roots = materialise(component_roots(links), "set-roots")
        more = materialise(foreign_pairs(members, sets, roots, nearest, similarity).join(tried, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            if nearest == 0:
                break
            continue
        links, tried = links.unionByName(verified(more, whole, similarity)), tried.unionByName(more)
    return links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One row per input row: id, n_shingles (size of its set), component_id (smallest id reachable by links)."""
    rows, keys, times = read_sets(docs, id_col, text_col, shingle)
    sets = distinct_sets(docs, text_col, keys, times, shingle, similarity)
    roots = materialise(component_roots(set_links(docs, sets, keys, times, text_col, shingle, similarity)), "roots")
    linked = sets.select("num", "sid").join(roots.withColumnRenamed("node", "num"), "num")
    least = rows.filter("n > 0").groupBy("sid").agg(F.min("id").alias("least"))
    named = materialise(least.join(linked.select("sid", "root"), "sid", "left"), "least-ids")
    groups = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(named.join(groups, "root", "left").select("sid", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")), "named")
    out = rows.join(named, "sid", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
