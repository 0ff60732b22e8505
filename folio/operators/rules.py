"""Rule tables: the four kinds of mapping rules of the crosswalk.

* exact one-to-one, with an ``&`` escape tested first (departments)
* exact one-to-many, unknown keys map to themselves (subjects)
* ordered first-match ``contains`` rules (degrees)
* ordered regular-expression replacements (``functions.text.replace_chain``)

Rules given as Python lists have a known size, so they become literal maps
or ``CASE`` expressions evaluated inside the scan stage - no join, no
shuffle.  Rules loaded as DataFrames (a user's CSV): one-to-many tables are
joined in long form, the planner choosing the join by their size; ordered
``contains`` tables become the same ``CASE`` expression
(``contains_rules_from_df``) or, when they are long, one automaton that reads
each text once (``contains_automaton``).  ``audit_contains`` and ``audit_map``
find rules that never apply, chains and cycles.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from itertools import chain

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col
from ..session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the automaton's tasks need no installed copy


def _map_literal(pairs) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), v) for k, v in pairs))


# -- exact one-to-one ---------------------------------------------------------
def exact_map(c: Column | str, mapping: dict[str, str], escape: tuple[str, str] | None = ("&", "and")) -> Column:
    """Exact, case-sensitive one-to-one map; unknown values map to
    themselves.  When ``escape=(x, y)`` a value containing ``x`` gets every
    ``x`` replaced by ``y`` and no further mapping."""
    v = col(c)
    if mapping:
        m = _map_literal((k, F.lit(t)) for k, t in mapping.items())
        mapped = F.coalesce(F.try_element_at(m, v), v)
    else:
        mapped = v
    if escape is None:
        return mapped
    return F.when(v.contains(escape[0]), F.replace(v, F.lit(escape[0]), F.lit(escape[1]))).otherwise(mapped)


# -- exact one-to-many --------------------------------------------------------
def one_to_many_array(values: Column | str, mapping: dict[str, list[str]]) -> Column:
    """Map every element of an array through a one-to-many table (unknown ->
    itself), keeping order, without de-duplication."""
    m = _map_literal((k, F.array(*[F.lit(t) for t in ts])) for k, ts in mapping.items())
    return F.flatten(F.transform(col(values), lambda v: F.coalesce(F.try_element_at(m, v), F.array(v))))


def one_to_many_rules_df(spark: SparkSession, mapping: dict[str, list[str]]) -> DataFrame:
    rows = [(k, i, t) for k, ts in mapping.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "key string, pos int, target string")


def one_to_many_join(long_df: DataFrame, key: str, rules: DataFrame, out: str = "target") -> DataFrame:
    """Long form: ``long_df`` has one row per value; ``rules`` is
    ``(key, pos, target)``.  Left join, unknown keys keep their value with
    ``tgt_pos = 0``.  The planner picks the join by the rule table's size."""
    r = rules.select(F.col("key").alias("__k"), F.col("pos").alias("tgt_pos"), F.col("target").alias("__t"))
    j = long_df.join(r, F.col(key) == F.col("__k"), "left")
    return j.select(
        *[c for c in long_df.columns],
        F.coalesce(F.col("tgt_pos"), F.lit(0)).alias("tgt_pos"),
        F.coalesce(F.col("__t"), F.col(key)).alias(out),
    )


# -- ordered contains rules ---------------------------------------------------
@dataclass(frozen=True)
class ContainsRule:
    parts: tuple[str, ...]
    target: str


def ordered_contains(c: Column | str, rules: list[ContainsRule], longest_match: bool = False) -> Column:
    """First rule (in order) whose parts are all contained in the value
    wins; no rule -> the value itself.  ``longest_match=True`` tries rules
    with longer combined parts first (so ``M.A.T.`` beats ``M.A.``)."""
    v = col(c)
    order = sorted(rules, key=lambda r: -sum(len(p) for p in r.parts)) if longest_match else rules
    out = None
    for r in order:
        cond = F.lit(True)
        for p in r.parts:
            cond = cond & v.contains(p)
        out = F.when(cond, F.lit(r.target)) if out is None else out.when(cond, F.lit(r.target))
    return v if out is None else out.otherwise(v)


def ordered_contains_df(spark: SparkSession, rules: list[ContainsRule]) -> DataFrame:
    return spark.createDataFrame([(i, list(r.parts), r.target) for i, r in enumerate(rules)], "ord int, parts array<string>, target string")


def contains_rules_from_df(rules: DataFrame) -> list[ContainsRule]:
    """Turn a loaded rule table ``(ord, parts, target)`` into the ordered
    rule list of ``ordered_contains``.  A site's rules are configuration, as
    if written in the program: they are read on the driver and run as one
    ``CASE`` expression inside the scan stage.  Tables that grow with the
    data are joined instead (``one_to_many_join``)."""
    rows = rules.orderBy("ord").collect()
    return [ContainsRule(tuple(r["parts"]), r["target"]) for r in rows]


def load_rules_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Load a user's rule table from CSV (header row, explicit schema)."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def exact_map_from_df(rules: DataFrame) -> dict[str, str]:
    """A loaded ``(key, target)`` table as the map of ``exact_map`` (the
    first row of a repeated key wins)."""
    out: dict[str, str] = {}
    for r in rules.withColumn("__row", F.monotonically_increasing_id()).orderBy("__row").collect():
        out.setdefault(r["key"], r["target"])
    return out


def one_to_many_from_df(rules: DataFrame) -> dict[str, list[str]]:
    """A loaded ``(key, pos, target)`` table as the map of
    ``one_to_many_array`` (targets in ``pos`` order)."""
    out: dict[str, list[str]] = {}
    for r in rules.orderBy("key", "pos").collect():
        out.setdefault(r["key"], []).append(r["target"])
    return out


# -- many contains rules: one automaton ------------------------------------------------
MAX_RULE_CHARS = 5_000_000  # of all parts of an automaton, which is broadcast


class PartAutomaton:
    """Aho-Corasick automaton of rule parts, with the rules that each part completes.

    States are numbers; ``moves`` holds a dictionary of characters per state,
    ``fails`` the state of the longest proper suffix, ``found`` the parts that
    end in a state or in the states its failure links lead to."""

    def __init__(self, rules: list[ContainsRule]):
        ids: dict[str, int] = {}
        self.needs, self.of_part, self.always = [], [], None
        for r, rule in enumerate(rules):
            parts = {p for p in rule.parts if p}
            if not parts and self.always is None:
                self.always = r
            self.needs.append(len(parts))
            for p in parts:
                if ids.setdefault(p, len(ids)) == len(self.of_part):
                    self.of_part.append([])
                self.of_part[ids[p]].append(r)
        self.moves: list[dict[str, int]] = [{}]
        ends: list[int | None] = [None]
        for part, i in ids.items():
            state = 0
            for c in part:
                nxt = self.moves[state].get(c)
                if nxt is None:
                    nxt = self.moves[state][c] = len(self.moves)
                    self.moves.append({})
                    ends.append(None)
                state = nxt
            ends[state] = i
        self.fails = [0] * len(self.moves)
        self.found: list[tuple[int, ...]] = [() if e is None else (e,) for e in ends]
        queue = list(self.moves[0].values())
        for state in queue:  # grows: breadth first
            for c, nxt in self.moves[state].items():
                fail = self.fails[state]
                while fail and c not in self.moves[fail]:
                    fail = self.fails[fail]
                self.fails[nxt] = self.moves[fail].get(c, 0)
                self.found[nxt] += self.found[self.fails[nxt]]
                queue.append(nxt)

    def first(self, text: str | None) -> int | None:
        """The first rule all of whose parts the text holds, in one pass over it."""
        if text is None:
            return None
        moves, fails, found = self.moves, self.fails, self.found
        seen: set[int] = set()
        left: dict[int, int] = {}
        best = len(self.needs) if self.always is None else self.always
        state = 0
        for c in text:
            while state and c not in moves[state]:
                state = fails[state]
            state = moves[state].get(c, 0)
            for part in found[state]:
                if part in seen:
                    continue
                seen.add(part)
                for r in self.of_part[part]:
                    if r < best:
                        left[r] = left.get(r, self.needs[r]) - 1
                        if not left[r]:
                            best = r
        return best if best < len(self.needs) else None


def contains_automaton(spark: SparkSession, c: Column | str, rules: list[ContainsRule]) -> Column:
    """As ``ordered_contains``, for long rule lists: each text is read once,
    whatever the number of rules, by one automaton of all parts.  The automaton
    is broadcast; its parts hold at most ``MAX_RULE_CHARS`` characters.  NULL
    stays NULL; without a rule that fits the value stays as it is."""
    size = sum(len(p) for r in rules for p in r.parts)
    if size > MAX_RULE_CHARS:
        raise ValueError(f"rule parts of {size} characters; at most {MAX_RULE_CHARS}")
    sent = spark.sparkContext.broadcast((vars(PartAutomaton(rules)), [r.target for r in rules]))  # plain data: executors need no installed copy

    @F.pandas_udf("string")
    def first(texts: pd.Series) -> pd.Series:
        state, targets = sent.value
        automaton = PartAutomaton([])
        vars(automaton).update(state)
        at = (automaton.first(t) for t in texts)
        return pd.Series([t if i is None else targets[i] for t, i in zip(texts, at)], dtype=object)

    return first(col(c))


# -- audit of rule tables -------------------------------------------------------------
def audit_contains(rules: DataFrame) -> DataFrame:
    """Rules that never apply: ``ord, by_ord`` for every rule of ``(ord, parts,
    target)`` whose parts hold all parts of an earlier rule, with the earliest
    such rule.

    A value that holds a text holds all of its substrings.  Rules of equal
    parts hide the same ones, so they meet once, by the earliest of them.  A
    rule is met by an equi-join of its two rarest parts (or its one) with the
    pairs of parts that others hold; with more parts it is then checked whole;
    a rule of no parts always applies.  Rules that hold more than ``PAIRED``
    parts are met by the rarest part alone and checked whole.  The lengths of
    parts are the only thing collected (``PART_LENGTHS`` at most; more are an
    error).  Null parts count as empty ones."""
    part = lambda c: F.transform("parts", lambda p: F.coalesce(p, F.lit("")))
    rules = rules.select("ord", F.array_distinct(F.coalesce(part("parts"), F.array().cast("array<string>"))).alias("parts"))
    rules = rules.select("ord", F.array_sort(F.filter("parts", lambda p: p != "")).alias("parts"))  # every text holds the empty one
    sets = rules.groupBy("parts").agg(F.min("ord").alias("least")).withColumn("id", F.monotonically_increasing_id())
    sets = written(sets, "part-sets")
    each = sets.select("id", F.explode("parts").alias("part"))
    lengths = [r.n for r in each.select(F.length("part").alias("n")).distinct().limit(PART_LENGTHS + 1).collect()]
    if len(lengths) > PART_LENGTHS:
        raise ValueError(f"rule parts of more than {PART_LENGTHS} different lengths")
    cut = lambda p, n: F.when(F.length(p) >= n, F.transform(F.sequence(F.lit(1), F.length(p) - n + 1), lambda i: F.substr(p, i, F.lit(n))))
    pieces = F.flatten(F.array(*[F.coalesce(cut(F.col("part"), n), F.array().cast("array<string>")) for n in sorted(lengths)])) if lengths else F.array().cast("array<string>")
    parts = each.select("part", F.explode(F.array_distinct(pieces)).alias("piece")) if lengths else each.select("part", F.col("part").alias("piece"))
    parts = parts.distinct().join(each.select(F.col("part").alias("piece")).distinct(), "piece", "left_semi")  # each different part is cut once
    held = written(each.join(parts, "part").select("id", F.col("piece").alias("part")).distinct(), "held")
    often = held.groupBy("part").agg(F.count(F.lit(1)).alias("f"))
    rarest = each.join(often, "part").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "part"))).alias("r"))
    second = F.get(F.col("r"), 1)["part"]
    one = F.get(F.col("r"), 0)["part"]
    early = rarest.select("id", one.alias("rare"), F.when(second.isNull(), F.array(one)).otherwise(F.array_sort(F.array(one, second))).alias("pair"))
    early = written(early.join(sets, "id").select(F.col("least").alias("by_ord"), "rare", "pair", F.col("parts").alias("needed")), "early")
    late = written(held.groupBy(F.col("id").alias("late")).agg(F.array_sort(F.collect_list("part")).alias("held")), "late")
    few = F.size("held") <= PAIRED
    pairs = F.flatten(F.transform("held", lambda x, i: F.concat(F.array(F.array(x)), F.transform(F.slice(F.col("held"), i + 2, F.size("held")), lambda y: F.array(x, y)))))
    met = late.filter(few).select("late", F.explode(pairs).alias("pair")).join(early, "pair").select("late", "by_ord", "needed")
    long_ = late.filter(~few).join(held.withColumnsRenamed({"id": "late", "part": "rare"}), "late").join(early, "rare")
    met = met.filter(F.size("needed") <= 2).unionByName(
        met.filter(F.size("needed") > 2).join(late, "late").unionByName(long_.select("late", "by_ord", "needed", "held")).filter(F.size(F.array_except("needed", "held")) == 0).drop("held")
    )
    first_empty = rules.filter(F.size("parts") == 0).agg(F.min("ord")).first()[0]  # one number
    hiding = sets.join(met.groupBy(F.col("late").alias("id")).agg(F.min("by_ord").alias("by_ord")), "id", "left")
    hiding = hiding.select("parts", F.least("by_ord", F.lit(first_empty).cast(rules.schema["ord"].dataType)).alias("by_ord"))
    return rules.join(hiding, "parts").filter("by_ord < ord").groupBy("ord").agg(F.min("by_ord").alias("by_ord"))


PAIRED = 48  # parts that a rule holds, of which all pairs are made
PART_LENGTHS = 256


def audit_map(rules: DataFrame, key: str = "key", target: str = "target") -> DataFrame:
    """Rules of a one-to-one map whose target is a key again: ``key, target,
    kind, steps, end``.

    ``chain``: the target is mapped further, ``steps`` times in all, to
    ``end``; ``cycle``: the rule is on a cycle, of which ``end`` is the least
    key and ``steps`` the length; ``into cycle``: it leads into one, which it
    reaches after ``steps``, at ``end``.  A rule that maps a key to itself is
    no fault, and ends a chain.  Repeated keys: the least target counts.  Null
    keys and targets are left out.

    Pointers are doubled, so a chain of n rules takes log2 n joins, each
    between written tables.  Only keys that are targets take part: every other
    rule is one step before its target and follows from it at the end."""
    base = rules.filter(F.col(key).isNotNull() & F.col(target).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(target).alias("t"))
    base = written(base, "map")
    every = base.filter("k <> t").select("k", "t")
    targets = every.select(F.col("t").alias("k")).distinct()
    moves = written(every.join(targets, "k", "left_semi"), "moves")
    outer = every.join(targets, "k", "left_anti")
    on = moves.join(moves.select(F.col("k").alias("t")), "t", "left_semi")  # rules that are mapped further
    # jump: where the pointer stands; least: the least key passed; n: rules followed
    now = written(moves.select("k", F.col("t").alias("jump"), F.lit(1).cast("long").alias("n"), F.col("k").alias("least")), "jumps")
    rounds = max(1, moves.count()).bit_length()
    for _ in range(rounds):
        right = now.select(F.col("k").alias("jump"), F.col("jump").alias("j2"), F.col("n").alias("n2"), F.col("least").alias("l2"))
        now = now.join(right, "jump", "left").select("k", F.coalesce("j2", "jump").alias("jump"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), F.least("least", F.coalesce("l2", "least")).alias("least"))
        now = written(now, "jumps")
    # After at least as many steps as there are rules, a pointer that still stands on a rule stands on a cycle; as
    # the steps only turn a cycle's own pointers round, all its keys are stood on, and each has passed the whole of it.
    endless = written(now.join(moves.select(F.col("k").alias("jump")), "jump", "left_semi").select("k", "jump"), "endless")
    cycle = written(moves.join(endless.select(F.col("jump").alias("k")).distinct(), "k", "left_semi"), "cycles")
    least = now.join(cycle.select("k"), "k", "left_semi").select("k", F.col("least").alias("end"))
    sizes = least.groupBy("end").agg(F.count(F.lit(1)).alias("steps"))
    cycles = cycle.join(least, "k").join(sizes, "end").select("k", "t", F.lit("cycle").alias("kind"), "steps", "end")
    chains = on.join(now.select("k", "jump", "n"), "k").join(endless.select("k"), "k", "left_anti").select("k", "t", F.lit("chain").alias("kind"), F.col("n").alias("steps"), F.col("jump").alias("end"))
    tails = written(moves.join(endless.select("k"), "k", "left_semi").join(cycle.select("k"), "k", "left_anti"), "tails")
    into = _entries(tails, cycle.select("k")).select("k", "t", F.lit("into cycle").alias("kind"), "steps", "end")
    inner = written(chains.unionByName(cycles).unionByName(into), "faults")
    # a rule whose target ends there is a chain of two; a target on a cycle is where it is reached
    ends = moves.join(on.select("k"), "k", "left_anti").select("k", F.lit("chain").alias("kind"), F.lit(1).cast("long").alias("steps"), F.col("t").alias("end"))
    reached = inner.select("k", F.when(F.col("kind") == "chain", "chain").otherwise("into cycle").alias("kind"), F.when(F.col("kind") == "cycle", F.lit(0).cast("long")).otherwise(F.col("steps")).alias("steps"), F.when(F.col("kind") == "cycle", F.col("k")).otherwise(F.col("end")).alias("end"))
    after = ends.unionByName(reached).withColumnRenamed("k", "t")
    before = outer.join(after, "t").select("k", "t", "kind", (F.col("steps") + 1).alias("steps"), "end")
    return inner.unionByName(before).select(F.col("k").alias(key), F.col("t").alias(target), "kind", "steps", "end")


def _entries(tails: DataFrame, cycle: DataFrame) -> DataFrame:
    """``k, t, steps, end`` of rules that lead into a cycle: the first key on it, by doubling steps that stop there."""
    stop = cycle.select(F.col("k").alias("end"), F.lit(True).alias("there"))
    now = written(tails.select("k", "t", F.col("t").alias("end"), F.lit(1).cast("long").alias("steps")).join(stop, "end", "left").withColumn("there", F.coalesce("there", F.lit(False))), "entries")
    while not now.filter("NOT there").isEmpty():
        ahead = now.select(F.col("k").alias("end"), F.col("end").alias("e2"), F.col("steps").alias("s2"), F.col("there").alias("t2"))
        far = now.filter("NOT there").join(ahead, "end").select("k", "t", F.col("e2").alias("end"), (F.col("steps") + F.col("s2")).alias("steps"), F.col("t2").alias("there"))
        now = written(now.filter("there").select(*far.columns).unionByName(far), "entries")
    return now
