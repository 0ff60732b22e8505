"""Matching: candidate lines, best match, authority reconciliation and the
blocked fuzzy join.

Work model at scale
-------------------
* Candidate generation and the native best match are array expressions on
  one document row: a narrow stage, no shuffle, no Python.  The best match
  bounds candidates by sums of per-line statistics and builds and scores only
  those that can still win, each edit distance limited by the best so far.
  A caller may limit the table cells of a search; what that leaves open is
  settled in an Arrow-batched pass (``settle_native``, ``settle_scores``).
* The matching-blocks ratio runs in one Arrow-batched pass per document row;
  inside it, candidates are scored by falling bound until none can win.
  Narrow, no shuffle.
* Authority lookups are equi-joins on a normalised key; the planner
  broadcasts a small list.
* ``suggestions`` lets a distinct value meet each block of the list once; in
  the block an index is read by falling score bound until the ``k``-th score
  cannot be beaten.
* ``fuzzy_join`` (both sides growing) joins on segments of a string that a
  partner must hold at a like place: only right strings that may hold one of
  the left's are shuffled, and only pairs of string keys move until they are
  verified with a length filter and a bounded Levenshtein distance.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blocks, fuzzy, segments, text
from ..session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # functions of a job need no installed copy


# -- M1: candidate line combinations -----------------------------------------
# The combinations and their order must equal the original's.
def reference_index_sets() -> list[tuple[int, ...]]:
    """The scored line combinations, in evaluation order (94 entries, 83
    distinct).  Built from the rule of the original list: leading singles
    and short combinations of lines 0-4, singles 4-10, adjacent pairs 4-10,
    singles 11-15 and again 11-25, adjacent pairs 4-26, adjacent triples
    4-27, the skip pair (0, 3) and the reversed pairs of lines 0-4."""
    seq: list[tuple[int, ...]] = [(0,), (1,), (2,), (3,), (0, 1), (0, 1, 2), (1, 2), (2, 3), (1, 2, 3), (3, 4), (0, 2), (1, 3)]
    seq += [(i,) for i in range(4, 11)]
    seq += [(i, i + 1) for i in range(4, 10)]
    seq += [(i,) for i in range(11, 16)]
    seq += [(i,) for i in range(11, 26)]
    seq += [(i, i + 1) for i in range(4, 26)]
    seq += [(i, i + 1, i + 2) for i in range(4, 26)]
    seq += [(0, 3)] + [(i + 1, i) for i in range(4)]
    return seq


def distinct_index_sets(sets: list[tuple[int, ...]] | None = None) -> list[tuple[int, tuple[int, ...]]]:
    """First occurrence of every distinct combination, with its position in
    the full list (a repeated candidate never changes a first-wins arg-max)."""
    seen: dict[tuple[int, ...], int] = {}
    for i, s in enumerate(sets or reference_index_sets()):
        seen.setdefault(s, i)
    return [(i, s) for s, i in seen.items()]


MIN_LINES = 28


def line_candidates(lines: Column, min_lines: int = MIN_LINES, indexed_sets: list[tuple[int, tuple[int, ...]]] | None = None) -> Column:
    """``array<struct<ord int, text string>>``: the combinations whose lines
    all exist, each joined with one blank.  A document with fewer than
    ``min_lines`` lines has no candidate."""
    if indexed_sets is None:
        indexed_sets = list(enumerate(reference_index_sets()))
    lit = F.array(*[F.struct(F.lit(o).alias("ord"), F.array(*[F.lit(i) for i in s]).alias("ix")) for o, s in indexed_sets])
    n = F.size(lines)
    valid = F.filter(lit, lambda c: F.array_max(c["ix"]) < n)
    built = F.transform(
        valid,
        lambda c: F.struct(c["ord"].alias("ord"), F.array_join(F.transform(c["ix"], lambda j: F.get(lines, j)), " ").alias("text")),
    )
    empty = F.array().cast("array<struct<ord:int,text:string>>")
    return F.when(F.coalesce(n, F.lit(0)) >= min_lines, built).otherwise(empty)


# -- M2: best match ------------------------------------------------------------
# Character classes for the bag-distance bound.
_LOWER, _NOT_UPPER = "\\p{Ll}+", "[^\\p{Lu}\\p{Lt}]+"
CANDIDATE_LINES = 28  # no combination reaches further


def class_counts(s: Column) -> Column:
    """``array<int>``: length, lower-case letters, upper/title-case letters, blanks.
    The lower-case letters go first, in runs; the other classes are counted in what is left."""
    rest = lambda r: F.array(F.length(s), F.length(s) - F.length(r), F.length(F.regexp_replace(r, _NOT_UPPER, "")), F.length(r) - F.length(F.replace(r, F.lit(" "), F.lit(""))))
    return text.let(F.regexp_replace(s, _LOWER, ""), rest)


def candidate_stats(lines: Column, min_lines: int = MIN_LINES) -> Column:
    """``array<struct<neg, ix, counts>>`` of the distinct combinations whose lines
    all exist: minus their place in the list, their lines and the class counts
    of their text (the sums of the lines' counts, plus one blank between lines)."""
    sets = F.array(*[F.struct(F.lit(-o).alias("neg"), F.array(*[F.lit(i) for i in s]).alias("ix"), F.lit(max(s)).alias("last")) for o, s in distinct_index_sets()])
    n = F.coalesce(F.size(lines), F.lit(0))
    valid = F.filter(sets, lambda c: (n >= min_lines) & (c["last"] < n))

    def summed(st: Column) -> Column:
        add = lambda x, y: F.array(*[F.get(x, k) + F.get(y, k) + (1 if k in (0, 3) else 0) for k in range(4)])
        line = lambda c, j: F.get(st, F.get(c["ix"], j))
        two = lambda c: add(line(c, 0), line(c, 1))
        counts = lambda c: F.when(F.size(c["ix"]) == 1, line(c, 0)).when(F.size(c["ix"]) == 2, two(c)).otherwise(text.let(two(c), lambda x: add(x, line(c, 2))))
        return F.transform(valid, lambda c: F.struct(c["neg"].alias("neg"), c["ix"].alias("ix"), counts(c).alias("counts")))

    return text.let(F.transform(F.slice(lines, 1, CANDIDATE_LINES), class_counts), summed)


def _score_of(m: Column, d: Column) -> Column:
    """Native score for ``d`` edits between strings of maximum length ``m``."""
    return F.when(m == 0, F.lit(100)).otherwise(F.floor((F.lit(200) * (m - d) + m) / (F.lit(2) * m)).cast("int"))


ROOM = 1 << 17  # table cells of a search that array expressions do faster than an Arrow pass


def best_line_native(lines: Column, keyword: Column, min_lines: int = MIN_LINES, stats: Column | None = None, room: int | None = None) -> Column:
    """``struct<score int, ord int, text string>`` of the best candidate by the
    native score; the first candidate wins ties; NULL without candidates.
    The text is stripped (NFKD is applied by ``best_line_ratio`` only).

    A candidate's class counts need no text (``candidate_stats``), nor does its
    bound: the bag distance over character classes (lower-case, upper-case,
    blank, other) never exceeds the edit distance.  Candidates are visited from
    the highest bound down, and only one that can still beat the best so far
    (ties go to the earlier candidate) is joined and scored (``_edits``), with a
    Levenshtein threshold derived from the best.  The result equals scoring
    every candidate.  ``stats``: ``candidate_stats(lines, min_lines)``, for
    callers that search several keywords.  ``room``: a search that takes more
    table cells is given up, and the struct has a field ``open`` that says so,
    for ``settle_native``."""

    def bounds(kc: Column, st: Column) -> Column:
        def bound(c):
            d = [F.get(c["counts"], k) - F.get(kc, k) for k in range(4)]
            # what only one side has and what only the other has differ by the lengths: the larger is half of sum and difference
            apart = F.shiftright(sum((F.abs(x) for x in [*d[1:], d[0] - d[1] - d[2] - d[3]]), F.abs(d[0])), 1)
            known = F.struct(F.greatest(F.get(kc, 0), F.get(c["counts"], 0)).alias("m"), apart.alias("low"))
            # an unknown bound (NULL keyword) cannot rule a candidate out
            return text.let(known, lambda b: F.struct(F.coalesce(_score_of(b["m"], b["low"]), F.lit(100)).alias("ub"), c["neg"].alias("neg"), c["ix"].alias("ix"), b["low"].alias("low")))

        return F.sort_array(F.transform(st, bound), asc=False)

    init = F.struct(F.lit(-1).alias("score"), F.lit(-(1 << 30)).alias("neg"), F.lit(None).cast("string").alias("text"), F.lit(1 << 62 if room is None else room).cast("long").alias("left"))

    def step(acc, c):
        def evaluate(text_c):
            m = F.greatest(F.length(keyword), F.length(text_c))
            # largest distance that still reaches the best score so far
            thr = F.floor(m * (F.lit(201) - F.lit(2) * F.greatest(acc["score"], F.lit(0))) / F.lit(200)).cast("int")

            def scored(lev):
                score = F.when(keyword.isNull(), F.lit(0)).when(lev < 0, F.lit(-1)).otherwise(_score_of(m, lev))
                better = (score > acc["score"]) | ((score == acc["score"]) & (c["neg"] > acc["neg"]))
                cells = fuzzy.table_cells(F.length(keyword), F.length(text_c), thr)
                left = (acc["left"] - F.when((lev >= 0) & (lev <= F.greatest(c["low"], F.lit(1))), F.lit(0)).otherwise(F.coalesce(cells, F.lit(0)))).alias("left")
                kept = F.struct(acc["score"].alias("score"), acc["neg"].alias("neg"), acc["text"].alias("text"), left)
                found = F.struct(score.alias("score"), c["neg"].alias("neg"), text_c.alias("text"), left)
                given_up = F.struct(acc["score"].alias("score"), acc["neg"].alias("neg"), acc["text"].alias("text"), F.lit(-1).cast("long").alias("left"))
                return F.when(lev.isNull() & keyword.isNotNull(), given_up).when(better, found).otherwise(kept)

            edits = text.let(thr, lambda most: _edits(keyword, text_c, most, c["low"], acc["score"] < 0, acc["left"]))
            return text.let(edits, scored)

        beats = (acc["left"] >= 0) & ((c["ub"] > acc["score"]) | ((c["ub"] == acc["score"]) & (c["neg"] > acc["neg"])))
        joined = F.array_join(F.transform(c["ix"], lambda j: F.get(lines, j)), " ")
        return F.when(beats, text.let(joined, evaluate)).otherwise(acc)

    def finish(acc):
        out = [acc["score"].alias("score"), (-acc["neg"]).alias("ord"), text.py_strip(acc["text"]).alias("text")]
        if room is not None:
            out.append((acc["left"] < 0).alias("open"))
        return F.when((acc["score"] >= 0) | (acc["left"] < 0), F.struct(*out))

    known = candidate_stats(lines, min_lines) if stats is None else stats
    return text.let(F.struct(class_counts(keyword).alias("k"), known.alias("s")), lambda x: F.aggregate(bounds(x["k"], x["s"]), init, step, finish))


FRONT_FROM = 64  # characters of strings whose beginnings are compared first


def _edits(a: Column, b: Column, most: Column, low: Column, first: Column, room: Column) -> Column:
    """Levenshtein distance of two strings, -1 beyond ``most``; ``low`` is at
    most the distance (or NULL).  NULL beyond ``room`` table cells.

    The ``first`` candidate, which nothing limits yet, and strings of equal
    length are laid side by side (``fuzzy.edits``).  For the others the
    beginnings are compared first: as no distance grows when both strings lose
    their last character, beginnings that are further apart than ``most``
    settle it."""
    la, lb = F.length(a), F.length(b)
    lev = lambda x, y: F.call_function("levenshtein", x, y, most)
    aligned = (F.least(la, lb) * 2 > F.greatest(la, lb)) & (first | (la == lb))
    front = F.greatest(most + F.floor(most / 2).cast("int"), la - lb) + 1
    settled = (F.least(la, lb) >= FRONT_FROM) & (front * 6 < la * 5) & (lev(F.left(a, front), F.left(b, front + lb - la)) < 0)
    limited = F.when(fuzzy.table_cells(la, lb, most) <= room, F.when(settled, F.lit(-1)).otherwise(lev(a, b)))
    return F.when(F.abs(la - lb) > most, F.lit(-1)).when(aligned, fuzzy.edits(a, b, most, low, room)).otherwise(limited)


def settle_native(df: DataFrame, lines: str, found: dict[str, str], min_lines: int) -> DataFrame:
    """The searches that ``best_line_native`` gave up, in one Arrow pass: one
    keyword meets many candidates at once, as bits (``blocks.best_native``).
    ``found``: its columns, and the columns of their keywords.  ``lines`` is
    only kept in rows that need it."""
    df = df.withColumn(lines, F.when(F.greatest(*[F.coalesce(F.col(c)["open"], F.lit(False)) for c in found]), F.col(lines)))
    sets = distinct_index_sets()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for c, keyword in found.items():
                parts = [columns[c].field(f).to_pylist() for f in ("score", "ord", "text", "open")]
                missing = columns[c].is_null().to_numpy(zero_copy_only=False)
                for i in [i for i, x in enumerate(parts[3]) if x and not missing[i]]:
                    score, at, joined = blocks.best_native(columns[keyword][i].as_py(), columns[lines][i].as_py(), sets, min_lines)
                    for part, value in zip(parts, (score, at, joined.strip(), False)):
                        part[i] = value
                fields = list(columns[c].type)
                columns[c] = pa.StructArray.from_arrays([pa.array(p, f.type) for p, f in zip(parts, fields)], fields=fields, mask=pa.array(missing))
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return df.mapInArrow(settle, df.schema)


def settle_scores(df: DataFrame, score: str, a: Column, b: Column) -> DataFrame:
    """The native scores of ``a`` and ``b`` that ``lev_score`` left NULL for want of room, in one Arrow pass."""
    out, missing = df.schema, F.col(score).isNull()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            x, y, found = columns.pop("__x"), columns.pop("__y"), columns[score].to_pylist()
            for i in np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False)).tolist():
                s, t = x[i].as_py(), y[i].as_py()
                found[i] = blocks.native_score(max(len(s), len(t)), int(blocks.Packed([t]).distances(s)[0]))
            columns[score] = pa.array(found, columns[score].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return df.withColumn("__x", F.when(missing, a)).withColumn("__y", F.when(missing, b)).mapInArrow(settle, out)


def best_line_ratio(lines: Column, keyword: Column, min_lines: int = MIN_LINES) -> Column:
    """``struct<score int, ord int, text string>`` of the best candidate by the
    matching-blocks ratio; the first candidate wins ties; NULLs without
    candidates.  The text is decomposed (NFKD) and stripped.

    One narrow, Arrow-batched pass: only the lines that candidates are made of
    go to Python, where ``blocks.best`` scores candidates by falling bound."""
    used = F.slice(lines, 1, max(CANDIDATE_LINES, min_lines))
    best = fuzzy.best_ratio(keyword, used, distinct_index_sets(), min_lines)
    return F.struct(best["score"].alias("score"), best["ord"].alias("ord"), text.py_strip(fuzzy.nfkd(best["text"])).alias("text"))


# -- J2 / J3: authority reconciliation ----------------------------------------------
def authority_keys(authority: DataFrame, name: str = "authority_name", order: str = "ord") -> DataFrame:
    """One row per normalised key: the earliest authority spelling.  Empty
    keys never match (an empty normalised value scores 0)."""
    k = authority.select(text.match_key(F.col(name)).alias("akey"), F.col(name).alias("aname"), F.col(order).alias("aord"))
    return k.filter(F.col("akey") != "").groupBy("akey").agg(F.min_by("aname", "aord").alias("aname"), F.min("aord").alias("aord"))


def reconcile(values: DataFrame, value: str, authority: DataFrame, name: str = "authority_name", order: str = "ord") -> DataFrame:
    """Adds ``resolved`` and ``status`` to ``values``.

    * ``pair``: the value holds ``first; second`` and both parts are
      authorised -> ``first; second`` in the value's own spelling;
    * ``exact``: the whole value is authorised -> the authority's spelling;
    * ``review``: neither -> ``resolved`` NULL.
    Matching compares normalised keys (``text.match_key``); three equi-joins,
    broadcast by the planner when the list is small."""
    keys = authority_keys(authority, name, order)
    first, second = text.split_pair(F.col(value))
    v = values.withColumn("__k", text.match_key(F.col(value))).withColumn("__f", first).withColumn("__s", second)
    v = v.withColumn("__kf", text.match_key(F.col("__f"))).withColumn("__ks", text.match_key(F.col("__s")))
    k1 = keys.select(F.col("akey").alias("__a1"), F.col("aname").alias("__n1"))
    k2 = keys.select(F.col("akey").alias("__a2"))
    k3 = keys.select(F.col("akey").alias("__a3"))
    j = v.join(k1, F.col("__k") == F.col("__a1"), "left").join(k2, F.col("__kf") == F.col("__a2"), "left").join(k3, F.col("__ks") == F.col("__a3"), "left")
    pair = F.col("__a2").isNotNull() & F.col("__a3").isNotNull()
    status = F.when(pair, "pair").when(F.col("__a1").isNotNull(), "exact").otherwise("review")
    resolved = F.when(pair, F.concat(F.col("__f"), F.lit("; "), F.col("__s"))).when(F.col("__a1").isNotNull(), F.col("__n1"))
    return j.select(*values.columns, resolved.alias("resolved"), status.alias("status"))


# -- J4: top-k suggestions ----------------------------------------------------------
LIST_BLOCK, VALUE_BLOCK = 1 << 16, 1 << 12  # names and values at most that meet in one group
LEAST_BLOCK = 1 << 8  # values a group of a short list
MOST_TASKS = 1 << 10


def suggestions(values: DataFrame, value: str, authority: DataFrame, k: int = 3, name: str = "authority_name", order: str = "ord") -> DataFrame:
    """Top ``k`` authority names for each distinct value by weighted score
    (``blocks.weighted``) on normalised keys; ties go to the earlier authority
    entry.  Returns ``value, rank, suggestion, score`` (long form).

    Exact over the whole list; entries that score 0 are no suggestion, nor has
    an empty key any.  The list is cut into blocks of about ``LIST_BLOCK``
    names, and a value meets each block once: one row a value and block.  In
    the block an index of lengths, word counts, words and characters is read
    by falling score bound until the ``k``-th score cannot be beaten
    (``blocks.NameIndex``).  ``k`` rows a value and block remain to be ranked."""
    keys = authority_keys(authority, name, order)
    d = values.select(F.col(value).alias("value")).distinct().withColumn("vkey", text.match_key(F.col("value"))).filter("vkey <> ''")
    several = lambda n, most: max(1, -(-n // most))
    n_keys = keys.count()
    parts = several(n_keys, LIST_BLOCK)
    deals = several(d.count(), min(VALUE_BLOCK, max(LEAST_BLOCK, n_keys // parts)))  # a group's values are as many as its names
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = d.select(dealt("value", deals).alias("deal"), every(parts).alias("part"), "value", "vkey")
    names = keys.select(every(deals).alias("deal"), dealt("akey", parts).alias("part"), "akey", "aname", F.col("aord").cast("long").alias("aord"))

    def best(asked: pa.Table, names: pa.Table) -> pa.Table:
        akeys, anames, aord = (names.column(c).to_pylist() for c in ("akey", "aname", "aord"))
        index = blocks.NameIndex(akeys, aord)
        out = [(v, anames[i], aord[i], score) for v, key in zip(asked.column("value").to_pylist(), asked.column("vkey").to_pylist()) for score, i in index.top(key, k)[0]]
        columns = zip(*out) if out else ((), (), (), ())
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int32()))], names=["value", "aname", "aord", "score"])

    # named numbers of tasks, twice the groups': the scores take long on few bytes, by which tasks would be put together
    tasks = min(2 * deals * parts, MOST_TASKS)
    asked, names = (df.repartition(tasks, "deal", "part") for df in (asked, names))
    scored = asked.groupBy("deal", "part").cogroup(names.groupBy("deal", "part")).applyInArrow(best, "value string, aname string, aord bigint, score int")
    by_value = Window.partitionBy("value").orderBy(F.col("score").desc(), "aord")
    return scored.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= k).select("value", "rank", F.col("aname").alias("suggestion"), "score")


# -- M3: blocked fuzzy join -------------------------------------------------------------
FILTER_BITS = 26  # of the bitmap of the left's segments, as a power of two


def fuzzy_join(left: DataFrame, left_id: str, left_s: str, right: DataFrame, right_id: str, right_s: str, rate: float, min_chars: int = 1) -> DataFrame:
    """All ``(left_id, right_id, dist)`` whose Levenshtein distance is at most
    ``rate`` times the longer length, rounded down (``rate`` < 0.2); strings
    shorter than ``min_chars`` take no part.

    Exact.  Equal strings meet in an equi-join, which is all that short
    strings (shorter than ``1 / rate``) can do.  For the others, a string of
    length n has at most ``k = rate * n / (1 - rate)`` edits to any partner;
    of the ``k + 1`` segments it is cut into one stands unchanged in the
    partner, moved by at most ``k`` places (``functions.segments``).

    The left strings give their segments; the right ones look up all their
    windows in a bitmap of these (``2 ** FILTER_BITS`` bits, broadcast), in
    the pass that reads them: rows that share nothing with the left go no
    further.  The others are written, with the windows that they share, and
    meet the segments in an equi-join.  Pairs of string keys are made
    distinct, and only then the texts are fetched to verify."""
    spark = left.sparkSession

    def side(df: DataFrame, i: str, s: str) -> DataFrame:
        return df.select(F.col(i).alias("id"), F.col(s).alias("s")).filter(F.length("s") >= min_chars)

    L = side(left, left_id, left_s).withColumn("key", F.md5("s"))
    k = F.floor(F.floor(F.length("s") / (1 - rate) + 1e-9) * rate + 1e-9).cast("int")
    ls = L.select("key", "s").distinct().withColumn("k", k)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, s, k in zip(*(c.to_pylist() for c in batch.columns)):
                width, keys, places = segments.given(s, k)
                n = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n), pa.array([len(s)] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array([width] * n, pa.int32()), pa.array(keys, pa.int64()), pa.array(places, pa.int32())], names=["lkey", "ln", "k", "width", "h", "lp"])

    given = written(ls.filter("k > 0").select("key", "s", "k").mapInArrow(cut, "lkey string, ln int, k int, width int, h bigint, lp int"), "segments")
    widths = sorted(r.width for r in given.select("width").distinct().collect())  # 1 / rate at most
    # the left's segments and whole strings as a bitmap
    bits, min_bits = FILTER_BITS, 6
    held = given.select("h").unionByName(L.select(F.xxhash64("s").alias("h")))
    slot = F.pmod(F.col("h"), F.lit(1 << bits))
    words = held.select(F.shiftright(slot, min_bits).alias("w"), F.expr("shiftleft(1L, CAST(pmod(h, 64) AS INT))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("v")).toPandas()
    table = np.zeros(1 << bits - min_bits, np.int64)
    table[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(table.view(np.uint64))  # 8 MB

    R = side(right, right_id, right_s).withColumn("whole", F.xxhash64("s"))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in segments.chunks(texts):
                of, keys, places = segments.looked_up(texts[a:b], widths, table, bits)
                equal = segments.in_table(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False).view(np.uint64), table, bits)
                equal[of] = True
                kept = pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:2]), *segments.lists(b - a, of, keys, places)], names=["id", "s", "hs", "ps"])
                yield kept.filter(pa.array(equal))

    id_type = R.schema["id"].dataType.simpleString()
    met = written(R.mapInArrow(shared, f"id {id_type}, s string, hs array<bigint>, ps array<bigint>"), "shared").withColumn("key", F.md5("s"))
    rs = met.dropDuplicates(["key"])
    looked = rs.select(F.col("key").alias("rkey"), F.length("s").alias("rn"), F.explode(F.arrays_zip("hs", "ps")).alias("x")).select("rkey", "rn", F.col("x.hs").alias("h"), F.col("x.ps").alias("rp"))
    near = F.abs(F.col("ln") - F.col("rn")) <= F.floor(F.greatest("ln", "rn") * rate).cast("int")
    pairs = given.join(looked, "h").filter(near & (F.abs(F.col("lp") - F.col("rp")) <= F.col("k"))).select("lkey", "rkey")
    texts = pairs.distinct().filter("lkey <> rkey").join(ls.select(F.col("key").alias("lkey"), F.col("s").alias("ltext")), "lkey")
    texts = texts.join(rs.select(F.col("key").alias("rkey"), F.col("s").alias("rtext")), "rkey")
    most = F.floor(F.greatest(F.length("ltext"), F.length("rtext")) * rate).cast("int")
    dist = F.call_function("levenshtein", F.col("ltext"), F.col("rtext"), most)
    close = texts.select("lkey", "rkey", dist.alias("dist")).filter("dist >= 0")
    equal = L.select(F.col("key").alias("lkey")).distinct().select("lkey", F.col("lkey").alias("rkey"), F.lit(0).alias("dist"))
    out = close.unionByName(equal).join(L.select(F.col("key").alias("lkey"), F.col("id").alias(left_id)), "lkey")
    return out.join(met.select(F.col("key").alias("rkey"), F.col("id").alias(right_id)), "rkey").select(left_id, right_id, "dist")
