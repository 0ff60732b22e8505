"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field that adds spans.

``base_spans`` are the matches of four fixed patterns.  The random field
works on windows, the runs of white-space-parted chunks that hold a digit or
an ``@``.  A window is cut into atoms (digit runs, letter runs, white space,
single other characters); a segmentation covers them with outside atoms and
entity segments of at most ``LONGEST`` atoms, and an entity never follows an
entity directly.  A candidate segment is scored by features of the whole span
(its shape, digit count, separators, checksum, octets, neighbours), one
weight vector per kind; outside atoms score 0.  Training maximises the
likelihood by stochastic gradients from forward-backward sums; decoding is
the matching Viterbi program.

The training windows are those of a bounded sample of texts, labelled by the
base patterns, with copies of phone and card spans rewritten to the
forms that the patterns miss (no country code, other separators).

Offsets are code points, ends exclusive.  Added spans never overlap a base
span.  Defined cases: null text counts as empty; overlapping base spans of
different kinds all stay; repeated rows are searched each; a table without
any window gets an empty model and base spans only; extra columns are kept by
``redact`` and dropped by ``find_spans``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
TRAIN_TEXTS, TRAIN_WINDOWS = 4000, 1500  # bounds of the training sample
EPOCHS, RATE, DECAY = 6, 0.2, 1e-4

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a digit run is entered at its first digit only
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]+")
ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans, by kind as listed, then start."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:  # the local part is the run of its characters before the @
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at) if begin < at else None
        if m:
            end = m.end()
            out.append(("email", begin, end))
        at = text.find("@", max(end, at + 1))
    if TRIGGER.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if _octets(m[0])]
        out += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of chunks that hold a digit or an @, parted by one blank at most."""
    begin = end = -1
    for m in TRIGGER.finditer(text):
        if m.start() < end:
            continue
        a = m.start()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        b = m.end()
        while b < len(text) and not text[b].isspace():
            b += 1
        if end >= 0 and a - end <= 1 and text[end : end + 1] == " ":
            end = b
            continue
        if end >= 0:
            yield begin, end
        begin, end = a, b
    if end >= 0:
        yield begin, end


def candidates(text: str, begin: int, end: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Atom boundaries of a window, and candidate segments as (first atom, atom after the last)."""
    bounds, kinds = [begin], []
    for m in ATOM.finditer(text, begin, end):
        c = m[0][0]
        kinds.append("d" if "0" <= c <= "9" else "a" if c.isalpha() else " " if c.isspace() else c)
        bounds.append(m.end())
    out, n = [], len(kinds)
    for i in range(n):
        if kinds[i] not in "da+(" or (i and kinds[i - 1] in "da"):
            continue
        digits, at, letters = 0, 0, 0
        for j in range(i, min(n, i + LONGEST)):
            k = kinds[j]
            if k == "d":
                digits += bounds[j + 1] - bounds[j]
            elif k == "a":
                letters += 1
            elif k == "@":
                at += 1
            elif k == " ":
                if at or letters or bounds[j + 1] - bounds[j] > 1:
                    break
                continue
            elif k not in "+().-_%":
                break
            if letters and not at and k in "()":
                break
            if (k in "da") and (j + 1 == n or kinds[j + 1] not in "da") and (at == 1 or (not letters and not at and digits >= 4)):
                out.append((i, j + 1))
    return bounds, out


def features(text: str, a: int, b: int) -> list[str]:
    """Features of the whole span [a, b)."""
    span = text[a:b]
    left, right = text[a - 1 : a], text[b : b + 1]
    side = lambda c: "" if not c else "s" if c.isspace() else "w" if c.isalnum() else c
    word = text[max(0, a - 20) : a].split()
    out = ["bias", f"l{side(left)}", f"r{side(right)}", f"w{word[-1].lower()[:12] if word else ''}"]
    if "@" in span:
        name, _, host = span.partition("@")
        labels = host.split(".")
        return [*out, "@", f"@labels{min(len(labels), 4)}", f"@last{labels[-1].isalpha()}", f"@empty{'' in labels or not name}", f"@odd{bool(set('()_%+') & set(host))}", f"@edge{name[:1] in '.+-'}"]
    runs = DIGITS.findall(span)
    digits = "".join(runs)
    n = len(digits)
    shape = DIGITS.sub(lambda m: "9" * min(len(m[0]), 6), span)
    out += [f"n{min(n, 20)}", f"g{min(len(runs), 8)}", f"first{span[0] if span[0] in '+(' else '9'}", "sep" + "".join(sorted(set(span) - set("0123456789"))), f"shape{shape[:40]}"]
    if 13 <= n <= 19:
        out.append(f"luhn{luhn(digits)}")
    if len(runs) == 4 and span.count(".") == 3 and len(span) == n + 3:
        out.append(f"octets{_octets(span)}")
    return out


def _add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -math.inf else x + math.log1p(math.exp(y - x))


class SpanModel:
    """Weights by (kind, feature)."""

    def __init__(self, weights: dict[str, dict[str, float]] | None = None):
        self.weights = weights or {k: {} for k in KINDS}

    def score(self, kind: str, feats: list[str]) -> float:
        w = self.weights[kind]
        return sum(w.get(f, 0.0) for f in feats)

    def step(self, n: int, segments: list[tuple[int, int, list[str]]], gold: dict[tuple[int, int], str], rate: float) -> None:
        """One gradient step on a window of ``n`` atoms; gold: kinds by segment."""
        arcs = [(i, j, k, f, self.score(k, f)) for i, j, f in segments for k in KINDS]
        ends: dict[int, list] = {}
        begins: dict[int, list] = {}
        for arc in arcs:
            ends.setdefault(arc[1], []).append(arc)
            begins.setdefault(arc[0], []).append(arc)
        out_f, ent_f = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1)
        for p in range(1, n + 1):
            out_f[p] = _add(out_f[p - 1], ent_f[p - 1])
            for i, _, _, _, s in ends.get(p, ()):
                ent_f[p] = _add(ent_f[p], out_f[i] + s)
        out_b, any_b = [-math.inf] * n + [0.0], [-math.inf] * n + [0.0]  # after an outside atom; after an entity
        for p in range(n - 1, -1, -1):
            any_b[p] = out_b[p + 1]  # an outside atom follows an entity
            out_b[p] = out_b[p + 1]
            for _, j, _, _, s in begins.get(p, ()):
                out_b[p] = _add(out_b[p], s + any_b[j])
        total = _add(out_f[n], ent_f[n])
        for i, j, k, f, s in arcs:
            slope = (gold.get((i, j)) == k) - math.exp(min(0.0, out_f[i] + s + any_b[j] - total))
            if abs(slope) > 1e-4:
                w = self.weights[k]
                for x in f:
                    w[x] = w.get(x, 0.0) * (1 - DECAY) + rate * slope

    def decode(self, text: str) -> list[tuple[str, int, int]]:
        """Spans of the best segmentation of each window."""
        out = []
        for begin, end in windows(text):
            bounds, segments = candidates(text, begin, end)
            ends: dict[int, list[tuple[int, str, float]]] = {}
            for i, j in segments:
                feats = features(text, bounds[i], bounds[j])
                s, k = max((self.score(k, feats), k) for k in KINDS)
                if s > 0:  # else outside atoms are at least as good
                    ends.setdefault(j, []).append((i, k, s))
            if not ends:
                continue
            n = len(bounds) - 1
            out_s, ent_s, back = [0.0] * (n + 1), [-math.inf] * (n + 1), {}
            for p in range(1, n + 1):
                out_s[p] = max(out_s[p - 1], ent_s[p - 1])
                for i, k, s in ends.get(p, ()):
                    if out_s[i] + s > ent_s[p]:
                        ent_s[p], back[p] = out_s[i] + s, (i, k)
            p, outside = n, out_s[n] >= ent_s[n]
            while p > 0:
                if outside:
                    outside = out_s[p - 1] >= ent_s[p - 1]
                    p -= 1
                else:
                    i, k = back[p]
                    out.append((k, bounds[i], bounds[p]))
                    p, outside = i, True
        return out


def variants(kind: str, span: str) -> list[str]:
    """Forms of a base span that the patterns miss."""
    runs = DIGITS.findall(span)
    if kind == "phone" and len(runs) >= 3:
        return [" ".join([f"({runs[1]})", "-".join(runs[2:])]), "-".join(runs[1:]), ".".join(runs[1:])]
    if kind == "card":
        d = "".join(runs)
        return [".".join(d[i : i + 4] for i in range(0, len(d), 4))]
    return []


def training_windows(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(snippet, gold spans) of a text's windows, and of their rewritten forms."""
    base, out = base_spans(text), []
    for a, b in windows(text):
        if b - a > 400:
            continue
        lo, hi = max(0, a - 24), min(len(text), b + 2)
        inside = [(k, x - lo, y - lo) for k, x, y in base if a <= x and y <= b]
        if len({p for _, x, y in inside for p in range(x, y)}) < sum(y - x for _, x, y in inside):
            continue  # overlapping base spans have no one segmentation
        snippet = text[lo:hi]
        out.append((snippet, inside))
        if len(inside) == 1:
            k, x, y = inside[0]
            out += [(snippet[:x] + v + snippet[y:], [(k, x, x + len(v))]) for v in variants(k, snippet[x:y])]
    return out


def fit(docs: DataFrame, text_col: str = "text", max_texts: int = TRAIN_TEXTS, max_windows: int = TRAIN_WINDOWS) -> SpanModel:
    """Train on the windows of at most about ``max_texts`` of the texts that may hold any, chosen by hash; at most
    ``max_windows`` are learned from, half of them with a base span where there are so many, and twice as many reach the driver."""
    texts = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    total = max(1, texts.count())
    share = min(1.0, max_texts / total)
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(max(1, int(share * 1_000_000))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(s, [f"{k}:{a}:{b}" for k, a, b in g]) for t in batch.column(0) for s, g in training_windows(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["snippet", "gold"])

    found = sample.mapInArrow(run, "snippet string, gold array<string>").distinct()
    found = materialise(found, "windows")
    least = lambda df: df.orderBy(F.xxhash64("snippet"), "snippet").limit(max_windows).collect()
    held, bare = least(found.filter(F.size("gold") > 0)), least(found.filter(F.size("gold") == 0))
    n = max(max_windows // 2, max_windows - len(bare))
    rows = held[:n] + bare[: max_windows - len(held[:n])]
    rows.sort(key=lambda r: hashlib.sha256(r.snippet.encode()).digest())  # mixed, in an order that only the texts decide
    model, prepared = SpanModel(), []
    for r in rows:
        gold_spans = {(int(a), int(b)): k for k, a, b in (g.split(":") for g in r.gold)}
        for begin, end in windows(r.snippet):
            bounds, segments = candidates(r.snippet, begin, end)
            if not segments:
                continue
            prepared.append((len(bounds) - 1, [(i, j, features(r.snippet, bounds[i], bounds[j])) for i, j in segments], {(i, j): gold_spans[bounds[i], bounds[j]] for i, j in segments if (bounds[i], bounds[j]) in gold_spans}))
    for epoch in range(EPOCHS):
        for n, segments, gold in prepared:
            model.step(n, segments, gold, RATE / (1 + epoch))
    return model


def all_spans(text: str, model: SpanModel) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind as listed, then start."""
    base = base_spans(text)
    added = [s for s in model.decode(text) if not any(s[1] < b and a < s[2] for _, a, b in base)] if TRIGGER.search(text) else []
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_spans(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans``: every span with its kind, code-point offsets and whether a base pattern gave it."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("spans", T._parse_datatype_string(SPANS))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                base, spans = all_spans(t.as_py() or "", model)
                known = set(base)
                out.append([{"kind": k, "start": a, "end": b, "base": (k, a, b) in known} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def redact(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of ``text_col`` replaced by its kind in brackets; overlapping spans become one of the first's kind."""
    at = docs.columns.index(text_col)

    def clean(text: str) -> str:
        parts, end = [], 0
        for kind, a, b in sorted(all_spans(text, model)[1], key=lambda s: (s[1], -s[2])):
            if a >= end:
                parts += [text[end:a], f"[{kind}]"]
            end = max(end, b)
        return "".join(parts) + text[end:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else clean(t) if TRIGGER.search(t) else t for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
