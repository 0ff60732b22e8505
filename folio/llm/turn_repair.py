"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is a row of turns.  Edits keep a turn, give it the other role,
delete it or insert an empty one, so that the roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in pairs.  The cheapest edits
are a shortest path through the states of that pattern; of all cheapest paths
the one whose edits' initials are least in ASCII is traced.

From the end, a cost vector says for each state what the rest costs at least.
A conversation is cut into chunks of at most ``CHUNK`` turns.  All chunks
start at once from a speculative vector (the last from the true one) and go
backwards; a chunk whose right neighbour's vector turns out to differ from
what it started with by more than a constant is run again, from the right,
until its vectors differ only by constants from those it had: from there on
the old ones hold.  Vectors forget their start after a few turns, so one
fix-up pass settles nearly every chunk; passes go on until none changes.  The
stitched vectors then drive the trace: a chunk is traced from each state it
may be entered in, the exits are chained by conversation, and the chunk's
initials follow.  Inserts at a chunk's border belong to the chunk behind it.

What moves: equal rows (conversation, turn, role, text) meet with a count,
added up on the map side.  All but the text then goes by range of
(conversation, turn, role, text digest), so that one very long conversation
lies in many partitions; chunks are one byte a turn.  Texts move once more, to
be hashed in order: a digest is one stream by its nature, so each conversation
is streamed by one task, which holds its initials and not its texts.

Defined cases: null role and text count as one space; null turns come first
and have no part in gaps; ties of turns go by role, then by the text's
SHA-256; equal rows are neighbours, all but the first are duplicates; a null
conversation id is one conversation; conversations without rows have zeros, an
empty audit and the digest of the empty string; an empty table gives an empty
result; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

CHUNK = 1 << 14  # turns
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping costs nothing

# states: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
FILLS = (USER, USER, ASSISTANT, USER)  # the state after the one role of user and assistant that may follow
END_COSTS = (0, 2 * INSERT, INSERT, 0)
SPECULATIVE = (0, 0, 0, 0)

# a turn's code: its role's initial, and bits
INITIALS = {"s": 0, "u": 1, "a": 2}  # others 3
MUST_DELETE, IS_TRUNCATED = 4, 8

KEPT_AS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}  # state, initial -> state


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):  # more inserts return to a state
        costs = [min(c, INSERT + costs[FILLS[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def back_step(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """The cost vector before a turn from that after it."""
    costs = []
    for q in range(4):
        c = DELETE + after[q]
        if not code & MUST_DELETE:
            extra = TRUNCATED if code & IS_TRUNCATED else 0
            c = min(c, REROLE + extra + after[FILLS[q]])
            kept = KEPT_AS.get((q, code & 3))
            if kept is not None:
                c = min(c, extra + after[kept])
        costs.append(c)
    return _with_inserts(costs)


def level(costs: tuple[int, ...]) -> tuple[int, ...]:
    """The vector less its least cost: equal for vectors that differ by a constant."""
    least = min(costs)
    return tuple(c - least for c in costs)


STEPS: dict[tuple, tuple] = {}  # few vectors exist, as costs differ by less than a few edits


def leveled_step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """The leveled vector before a turn, and by how much it was leveled."""
    key = (after, code)
    found = STEPS.get(key)
    if found is None:
        costs = back_step(after, code)
        found = STEPS[key] = level(costs), min(costs)
    return found


def backwards(codes: bytes, start: tuple[int, ...], old: list[tuple[int, ...]] | None = None) -> list[tuple[int, ...]]:
    """Leveled vectors at every place of a chunk, the last being ``start``.  ``old``: those of an earlier
    run; once they differ only by a constant they are taken over."""
    now = level(start)
    out = [now]
    for i in range(len(codes) - 1, -1, -1):
        now = leveled_step(now, codes[i])[0]
        if old is not None and old[i] == now:
            return old[: i + 1] + out[::-1]
        out.append(now)
    return out[::-1]


def trace(codes: bytes, vectors: list[tuple[int, ...]], state: int, last: bool) -> tuple[str, int, int]:
    """The least initials of cheapest edits from ``state``, the state behind them, and their cost."""
    out, cost = [], 0
    i = 0
    while True:
        here = vectors[i]
        if i == len(codes):
            if last and END_COSTS[state]:
                out.append("I")
                state, cost = FILLS[state], cost + INSERT
                continue
            return "".join(out), state, cost
        code, after = codes[i], vectors[i + 1]
        target = here[state] + leveled_step(after, code)[1]
        extra = TRUNCATED if code & IS_TRUNCATED else 0
        free = not code & MUST_DELETE
        kept = KEPT_AS.get((state, code & 3)) if free else None
        if DELETE + after[state] == target:
            out.append("D")
            cost, i = cost + DELETE, i + 1
        elif INSERT + here[FILLS[state]] == here[state]:
            out.append("I")
            cost, state = cost + INSERT, FILLS[state]
        elif kept is not None and extra + after[kept] == target:
            out.append("K")
            cost, state, i = cost + extra, kept, i + 1
        else:
            out.append("R")
            cost, state, i = cost + REROLE + extra, FILLS[state], i + 1


#: Fault of a turn: the first that fits.
BLANK, DUPLICATE, CUT = 1, 2, 3
SPACE = " \t\n\x0b\x0c\r"
CHUNKS = "conv_id {0}, part int, chunk bigint, turn {1}, role string, digest binary, codes binary, last boolean, blank bigint, duplicate bigint, truncated bigint"


def turn_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times: str | None = None) -> DataFrame:
    """Distinct rows with their count; ``times``: a column that says how often each row is there."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), value(role_col).alias("role"), value(text_col).alias("text"), (F.col(times) if times else F.lit(1)).cast("long").alias("n"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    return rows.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.min("text").alias("text"))


def chunks(rows: DataFrame) -> DataFrame:
    """Conversations cut into chunks: one byte a turn, the place of the first turn, and counts of faults.

    ``rows``: what ``turn_rows`` gives, with ``blank`` and ``cut_off`` flags in place of the text."""
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    a, b = rows.alias("a"), first.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    marked = a.join(b, same).select("a.*", (~F.col("a.turn").eqNullSafe(F.col("b.first.turn"))).alias("seen"))
    order = ["conv_id", "turn", "role", "digest"]
    schema = CHUNKS.format(rows.schema["conv_id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString())
    names = [f.split()[0] for f in schema.split(", ")]
    size = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, types = TaskContext.get().partitionId(), None
        codes, faults, begin, number, now, started = bytearray(), [0, 0, 0, 0], None, 0, None, False

        def sent() -> pa.RecordBatch:
            cells = [begin[0], part, number, *begin[1:], bytes(codes), False, *faults[1:]]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], names=names)

        for batch in batches:
            kinds = [batch.schema.field(c).type for c in order]
            types = [kinds[0], pa.int32(), pa.int64(), kinds[1], pa.string(), pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            for conv, turn, role, digest, n, blank, cut_off, seen in zip(*(batch.column(c).to_pylist() for c in (*order, "n", "blank", "cut_off", "seen"))):
                if not started or conv != now:
                    if codes:
                        yield sent()
                    codes, faults, begin, number, now, started = bytearray(), [0, 0, 0, 0], None, 0, conv, True
                initial = INITIALS.get(role[:1], 3)
                alone = BLANK if blank else DUPLICATE if seen else CUT if cut_off else 0
                again = BLANK if blank else DUPLICATE
                left, fault = n, alone
                while left:
                    if len(codes) == size:
                        yield sent()
                        codes, faults, begin, number = bytearray(), [0, 0, 0, 0], None, number + 1
                    if begin is None:
                        begin = (conv, turn, role, digest)
                    take = 1 if fault == alone and left == n else min(left, size - len(codes))
                    codes += bytes([initial | (MUST_DELETE if fault in (BLANK, DUPLICATE) else 0) | (IS_TRUNCATED if fault == CUT else 0)]) * take
                    faults[fault] += take
                    left, fault = left - take, again
        if codes:
            yield sent()

    cut = marked.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, "n", "blank", "cut_off", "seen").mapInArrow(run, schema)
    return materialise(cut, "turn-chunks")


def _linked(cut: DataFrame) -> DataFrame:
    """Chunks with a number ``at`` in their conversation and whether they are the last.

    Only conversations of several chunks meet here, without their codes."""
    ends = cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("chunks"), F.max(F.struct("part", "chunk")).alias("final"))
    a, b = cut.drop("last").alias("a"), ends.alias("b")
    joined = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))).select("a.*", "chunks", (F.struct("a.part", "a.chunk") == F.col("final")).alias("last"))
    return joined


def _numbers(v: list[tuple[int, ...]]) -> bytes:
    return np.array(v, np.uint8).tobytes()


def _vectors(data: bytes) -> list[tuple[int, ...]]:
    return list(map(tuple, np.frombuffer(data, np.uint8).reshape(-1, 4).tolist()))


def _map_rows(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` of each row's dict gives a row's dict of ``schema``."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = dict(zip(batch.schema.names, batch.schema.types))
            for at in range(0, batch.num_rows, 64):
                rows = [fn(r) for r in batch.slice(at, 64).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c) or FIELD_TYPES[c]) for c in names], names=names)

    return df.mapInArrow(run, schema)


FIELD_TYPES = {"vectors": pa.binary(), "left": pa.binary(), "exits": pa.list_(pa.int32()), "audit": pa.string(), "cost": pa.int64(), "changed": pa.bool_()}


def solved(cut: DataFrame) -> DataFrame:
    """Adds ``vectors`` (4 bytes a place: leveled costs to the end) to the chunks, right for all of them."""
    linked = _linked(cut)
    id_type = cut.schema["conv_id"].dataType.simpleString()
    turn_type = cut.schema["turn"].dataType.simpleString()
    schema = CHUNKS.format(id_type, turn_type) + ", chunks bigint, vectors binary, left binary"

    def speculate(r: dict) -> dict:
        v = backwards(r["codes"], END_COSTS if r["last"] else SPECULATIVE)
        return r | {"vectors": _numbers(v), "left": _numbers(v[:1])}

    now = materialise(_map_rows(linked, speculate, schema), "vectors")
    single = now.filter("chunks = 1")
    several = now.filter("chunks > 1")
    if several.isEmpty():
        return now

    def fix(r: dict) -> dict:
        if r["start"] is None or r["start"] == r["vectors"][-4:]:
            return r | {"changed": False}
        v = backwards(r["codes"], tuple(r["start"]), _vectors(r["vectors"]))
        return r | {"vectors": _numbers(v), "left": _numbers(v[:1]), "changed": _numbers(v[:1]) != r["left"]}

    # neighbours: number the chunks of the few conversations that have several, by their keys alone
    keys = several.select("conv_id", "part", "chunk")
    runs = keys.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    by_conv = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("runs"))  # at most one entry a partition
    before = F.aggregate(F.filter("runs", lambda x: x["part"] < F.col("a.part")), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    a, b = several.alias("a"), by_conv.alias("b")
    several = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))).select("a.*", (before + F.col("a.chunk")).alias("at"))
    several = materialise(several, "chained")
    while True:
        right = several.select(F.col("conv_id").alias("c"), (F.col("at") - 1).alias("before"), F.col("left").alias("start"))
        found = several.join(right, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("before")), "left").drop("c", "before")
        fixed = materialise(_map_rows(found, fix, schema + ", at bigint, changed boolean"), "fixed")
        several = fixed.drop("changed")
        if fixed.filter("changed").isEmpty():
            break
    return single.withColumn("at", F.lit(0).cast("long")).unionByName(several)


def traced(done: DataFrame) -> DataFrame:
    """Chunks with their edits' initials and cost; columns of the place, ``audit``, ``cost`` and the fault counts."""
    id_type, turn_type = (done.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    if "at" not in done.columns:
        done = done.withColumn("at", F.lit(0).cast("long"))
    out_schema = f"conv_id {id_type}, at bigint, turn {turn_type}, role string, digest binary, blank bigint, duplicate bigint, truncated bigint, audit string, cost bigint"

    def exits(r: dict) -> dict:
        v = _vectors(r["vectors"])
        return {"conv_id": r["conv_id"], "at": r["at"], "exits": [trace(r["codes"], v, q, r["last"])[1] for q in range(4)]}

    def follow(r: dict) -> dict:
        audit, _, cost = trace(r["codes"], _vectors(r["vectors"]), r["enter"], r["last"])
        return r | {"audit": audit, "cost": cost}

    ways = _map_rows(done.filter("chunks > 1"), exits, f"conv_id {id_type}, at bigint, exits array<int>")
    # the state before each chunk: the exits of those before it, chained (an entry of five numbers a chunk)
    chain = ways.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "exits"))).alias("ways"))
    step = lambda s, w: F.struct(F.concat(s["enter"], F.array(s["now"])).alias("enter"), F.element_at(w["exits"], s["now"] + 1).alias("now"))
    start = F.struct(F.array().cast("array<int>").alias("enter"), F.lit(START).alias("now"))
    entered = chain.select(F.col("conv_id").alias("c"), F.posexplode(F.aggregate("ways", start, step)["enter"]).alias("p", "enter"))
    one = done.filter("chunks = 1").withColumn("enter", F.lit(START))
    more = done.filter("chunks > 1").join(entered, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("p"))).drop("c", "p")
    return _map_rows(one.unionByName(more), follow, out_schema)


REPAIRED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(turns: DataFrame, ids: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times: str | None = None) -> DataFrame:
    """One row per conversation of ``ids`` (column ``conv_col``) and ``turns``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = materialise(turn_rows(turns, conv_col, turn_col, role_col, text_col, times), "turns")
    solid = F.rtrim("text", F.lit(SPACE))
    light = rows.select("conv_id", "turn", "role", "digest", "n", (solid == "").alias("blank"), (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut_off"))
    edits = traced(solved(chunks(light)))
    id_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    order = ["conv_id", "turn", "role", "digest"]
    lacking = lambda df, **types: df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})
    every = dict(turn=turn_type, role="string", digest="binary", at="bigint", n="bigint", text="string", audit="string", cost="bigint", blank="bigint", duplicate="bigint", truncated="bigint")
    columns = ["kind", "conv_id", *every]
    known = ids.select(F.col(conv_col).alias("conv_id")).union(rows.select("conv_id")).distinct().withColumn("kind", F.lit(0))
    stream = [lacking(df, **every).select(*columns) for df in (known, edits.withColumn("kind", F.lit(1)), rows.withColumn("kind", F.lit(2)))]
    whole = stream[0].unionByName(stream[1]).unionByName(stream[2])
    # a conversation's own row first, then by turn; the edits of a chunk before its first turn
    whole = whole.repartition("conv_id").withColumn("body", F.col("kind") > 0).sortWithinPartitions("conv_id", "body", "turn", "role", "digest", "kind", "at")
    names = ["conv_id", *REPAIRED, "audit", "repaired_sha256"]
    schema = f"conv_id {id_type}, " + ", ".join(f"{c} bigint" for c in REPAIRED) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        conv = None

        def batch_of() -> pa.RecordBatch:
            types = [id_kind, *[pa.int64()] * len(REPAIRED), pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            return made

        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            for r in zip(*(batch.column(c).to_pylist() for c in columns)):
                kind, conv_id, turn, role, _, _, n, text, audit, cost, blank, duplicate, truncated = r
                if kind == 0:
                    if conv is not None:
                        out.append(conv.result())
                        if len(out) >= 1000:
                            yield batch_of()
                    conv = Conversation(conv_id)
                elif kind == 1:
                    conv.add_edits(audit, cost, blank, duplicate, truncated)
                else:
                    conv.add_turn(turn, role, text, n)
        if conv is not None:
            out.append(conv.result())
        if out:
            yield batch_of()

    return whole.select(*columns).mapInArrow(run, schema)


class Conversation:
    """A conversation as it streams by: its repaired turns go into a digest."""

    def __init__(self, conv_id):
        self.conv_id, self.digest, self.first = conv_id, hashlib.sha256(), True
        self.audit, self.queue, self.at, self.state = [], "", 0, START
        self.counts = [0] * 4  # blank, duplicate, truncated, cost
        self.illegal, self.initial, self.turns, self.distinct, self.low, self.high = 0, None, 0, 0, None, None

    def add_edits(self, audit, cost, blank, duplicate, truncated):
        self.audit.append(audit)
        self.queue, self.at = self.queue[self.at :] + audit, 0
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated, cost))]

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _inserts(self) -> None:
        while self.queue[self.at : self.at + 1] == "I":
            self.state = FILLS[self.state]
            self._put("user" if self.state == USER else "assistant", "")
            self.at += 1

    def add_turn(self, turn, role, text, n):
        if turn is not None:
            if turn != self.high:
                self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        self.illegal += (self.initial is not None and self.initial + initial not in ("su", "ua", "au")) + (n - 1 if initial * 2 not in ("su", "ua", "au") else 0)
        self.initial = initial
        while n:
            self._inserts()
            edit = self.queue[self.at]
            if edit == "D":  # all copies but the first
                most = min(n, len(self.queue) - self.at)
                run = re.compile("D+").match(self.queue, self.at, self.at + most).end() - self.at
                self.at, n = self.at + run, n - run
                continue
            if edit == "K":
                self.state = KEPT_AS[self.state, INITIALS[initial]]
                self._put(role, text)
            else:
                self.state = FILLS[self.state]
                self._put("user" if self.state == USER else "assistant", text)
            self.at, n = self.at + 1, n - 1

    def result(self) -> list:
        self._inserts()
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        blank, duplicate, truncated, cost = self.counts
        return [self.conv_id, gaps, blank, duplicate, truncated, self.illegal, cost, "".join(self.audit), self.digest.hexdigest()]


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by the crc32 of ``conversation:turn`` modulo 20; nulls as one space; ``times`` says how often a row is there.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(value(conv_col), F.lit(":"), value(turn_col)).cast("binary")) % 20
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), value(role_col).alias("role"), value(text_col).alias("text"), how.alias("how")).filter("how <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("how") == 3, 2).otherwise(1).alias("times"),
    )
