"""Toxicity grades by cumulative-link ordinal regression.

Grades 0, 1, ... G are ordered; the model is P(grade <= j | x) =
sigmoid(t_j - w.x) with rising thresholds t_0 < t_1 < ... and one weight
vector for all of them.  x is sparse: which of the model's words a text
holds.  The expected severity is the sum over j of P(grade > j); a text is
toxic if P(grade > 0) is at least one half.

Words are a whole text's lower-cased white-space chunks without outer
punctuation, and, marked ``*``, their beginnings of four and five letters, so
that inflected forms share weight.  The vocabulary is chosen by the labels: words of at least
``LEAST`` sample texts that are ``LIFT`` times as frequent in texts above
grade 0 as in the others, by a z-score of ``Z``.  They are chosen one by one,
and texts that already hold ``DEPTH`` chosen words no longer count, so words
that only go along with others, as in copies of a text, stay out.  Training reads a sample of at most about
``PER_CLASS`` grade-0 texts and as many others, chosen by a hash of the id;
rows weigh as many rows as they stand for.  Only words that the rule may
choose, and which of them each sample text holds, reach the driver.

Where labels only say toxic or not, ``severity_grades`` spreads the toxic
texts over the grades 1 to 3 by how much of the sample's toxic vocabulary they hold.

Defined cases: a null or empty text holds no word; null labels are
unlabelled, and of several labels of an id the highest counts; a sample
without two different grades gives a model that grades everything as its
only grade (0 without any); repeated rows are judged each; extra columns are
dropped by ``grade_texts``.
"""

from __future__ import annotations

import heapq
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

PER_CLASS = 2000
LEAST, Z, LIFT, DEPTH, WORDS = 5, 4.0, 4.0, 3, 5000
STEPS, RATE, RIDGE = 2500, 0.1, 1e-7
OUTER = string.punctuation + "«»“”„‘’…–—¡¿"


def text_words(text: str | None) -> set[str]:
    words = {w.strip(OUTER) for w in set((text or "").lower().split())}
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def select_words(texts: list[set[str]], positive: np.ndarray) -> list[str]:
    """The vocabulary: the word of the highest z-score, again and again, counting only positive texts that hold fewer than ``DEPTH`` chosen words."""
    n1, n0 = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    holders: dict[str, list[int]] = {}
    for i, t in enumerate(texts):
        if positive[i]:
            for w in t:
                holders.setdefault(w, []).append(i)
    in0 = Counter(w for t, p in zip(texts, positive) if not p for w in t)

    def z(w: str, a: int) -> float:
        b = in0[w]
        if not w.strip("*") or a + b < LEAST or a / n1 < LIFT * b / n0:
            return 0.0
        rate = (a + b) / (n1 + n0)
        return (a / n1 - b / n0) / max((rate * (1 - rate) * (1 / n1 + 1 / n0)) ** 0.5, 1e-9)

    queue = [(-s, w) for w, h in holders.items() if (s := z(w, len(h))) >= Z]
    heapq.heapify(queue)
    held, chosen = [0] * len(texts), []
    while queue and len(chosen) < WORDS:
        stale, w = heapq.heappop(queue)
        now = z(w, sum(held[i] < DEPTH for i in holders[w]))
        if now < Z:
            continue
        if -stale > now:  # texts were covered meanwhile
            heapq.heappush(queue, (-now, w))
            continue
        chosen.append(w)
        for i in holders[w]:
            held[i] += 1
    return chosen


class OrdinalModel:
    """Weights by word, and thresholds."""

    def __init__(self, words: list[str], weights: np.ndarray, thresholds: np.ndarray, lowest: int = 0):
        self.weights = {w: float(x) for w, x in zip(words, weights)}
        self.known = frozenset(words)
        self.thresholds = [float(t) for t in thresholds]
        self.lowest = lowest

    def above(self, text: str | None) -> list[float]:
        """P(grade > j) for each threshold j."""
        x = sum(self.weights[w] for w in self.known & text_words(text))
        return [1 / (1 + np.exp(min(700.0, t - x))) for t in self.thresholds]


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, weight: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of greatest penalised likelihood; rows: indexes of the words held."""
    flat = np.array([c for r in rows for c in r], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    top = int(grades.max())
    share = weight / weight.sum()
    below = [min(max(float(share[grades <= j].sum()), 1e-3), 1 - 1e-3) for j in range(top)]
    cuts = np.maximum.accumulate(np.log(np.array(below) / (1 - np.array(below))) + np.arange(top) * 1e-3)
    # parameters: weights, first threshold, logarithms of the gaps between thresholds
    p = np.concatenate([np.zeros(n_words), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, gaps = p[:n_words], np.exp(p[n_words + 1 :])
        t = p[n_words] + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(owner, w[flat], len(rows)) if len(flat) else np.zeros(len(rows))
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        with np.errstate(over="ignore"):
            cdf = 1 / (1 + np.exp(-(edges[None, :] - x[:, None])))
        hi, lo = cdf[np.arange(len(x)), grades + 1], cdf[np.arange(len(x)), grades]
        chance = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / chance * share, lo * (1 - lo) / chance * share  # d log-likelihood by the edges
        g_x = d_hi - d_lo  # minus the derivative by x
        g_w = (np.bincount(flat, g_x[owner], n_words) if len(flat) else np.zeros(n_words)) + RIDGE * w
        g_t = np.array([-(d_hi[grades == j].sum()) + d_lo[grades == j + 1].sum() for j in range(top)])
        g = np.concatenate([g_w, [g_t.sum()], gaps * np.cumsum(g_t[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_words], p[n_words] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_words + 1 :]))])


def severity_grades(texts: list[set[str]], toxic: np.ndarray) -> np.ndarray:
    """0 for texts that are not toxic; toxic ones get 1, 2 or 3 by thirds of their count of words that mark toxic texts."""
    marks = set(select_words(texts, toxic))
    load = np.array([len(marks & t) for t in texts])
    if not toxic.any():
        return np.zeros(len(texts), int)
    low, high = np.quantile(load[toxic], [1 / 3, 2 / 3])
    return np.where(toxic, 1 + (load > low).astype(int) + (load > max(high, low + 1)).astype(int), 0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, graded: bool = False) -> OrdinalModel:
    """Train on the texts that ``labels`` (id, label) covers; ``graded``: labels are grades, else 0 and 1."""
    judged = labels.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("grade"))
    bad, clean = judged.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") <= 0)).first()
    scale = 1_000_000
    part = lambda n: -(-per_class * scale // max(1, n))
    chosen = judged.filter(F.pmod(F.xxhash64(id_col), F.lit(scale)) < F.when(F.col("grade") > 0, F.lit(part(bad))).otherwise(F.lit(part(clean))))
    # about 2 * per_class ids, so they are broadcast and the texts stay where they are; each class is bounded by itself
    bounded = lambda df: df.filter("grade > 0").limit(2 * per_class).unionAll(df.filter("grade <= 0").limit(2 * per_class))
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(bounded(chosen.withColumnRenamed(id_col, "id"))), "id")
    # rows that repeat an id and its text count once, so that they push nothing out
    once = materialise(found.withColumn("digest", F.xxhash64("text")).dropDuplicates(["id", "grade", "digest"]).select("grade", "text"), "chosen")
    sample = materialise(bounded(once), "labelled")
    n1, n0 = (max(1, n) for n in sample.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") <= 0)).first())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for grade, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[grade > 0].update(text_words(text.as_py()))
            words = list(held[True] | held[False])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[True][w] for w in words], pa.int64()), pa.array([held[False][w] for w in words], pa.int64())], names=["word", "a", "b"])

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(number[w] for w in number.keys() & text_words(t.as_py())) for t in batch.column(1)], pa.list_(pa.int64()))], names=["grade", "held"])

    counts = sample.mapInArrow(count, "word string, a bigint, b bigint").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b, rate = F.col("a"), F.col("b"), (F.col("a") + F.col("b")) / (n1 + n0)
    z = (a / n1 - b / n0) / F.greatest(F.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0)), F.lit(1e-9))
    likely = counts.filter((a + b >= LEAST) & (a / n1 >= LIFT * b / n0) & (z >= Z - 1e-6))  # select_words tests anew
    words = sorted(r.word for r in likely.select("word").collect())
    number = {w: i for i, w in enumerate(words)}
    rows = sample.mapInArrow(hold, "grade int, held array<bigint>").collect()
    rows.sort(key=lambda r: (r.grade, r.held))
    texts = [{words[i] for i in r.held} for r in rows]
    grades = np.array([max(0, r.grade) for r in rows], int)
    if len(set(grades.tolist())) < 2:
        return OrdinalModel([], np.zeros(0), np.zeros(0), int(grades[0]) if len(grades) else 0)
    positive = grades > 0
    weight = np.where(positive, max(1, bad) / positive.sum(), max(1, clean) / (~positive).sum())
    if not graded:
        grades = severity_grades(texts, positive)
    words = select_words(texts, positive)
    at = {w: i for i, w in enumerate(words)}
    return OrdinalModel(words, *fit_ordinal([[at[w] for w in t if w in at] for t in texts], grades, weight, len(words)))


def grade_texts(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, grade, severity, p_toxic, toxic`` per row; grade: how many thresholds are more likely passed than not."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("grade", T.LongType()), T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = [model.above(t.as_py()) or [float(model.lowest > 0)] for t in batch.column(1)]
            columns = [
                pa.array([model.lowest + sum(p >= 0.5 for p in a) if model.thresholds else model.lowest for a in above], pa.int64()),
                pa.array([float(sum(a)) if model.thresholds else float(model.lowest) for a in above], pa.float64()),
                pa.array([float(a[0]) for a in above], pa.float64()),
                pa.array([bool(a[0] >= 0.5) for a in above], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not toxic, whole."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([(model.above(t.as_py()) or [float(model.lowest > 0)])[0] < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
