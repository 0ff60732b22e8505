"""Language identification in two steps.

Linear support vector machines first tell language families apart (one
against the rest), then, within the family found, every pair of its languages
(one against one, by votes; ties go to the larger sum of margins, then to the
first name).  Features are the square roots of hashed byte-trigram counts of
the lower-cased whole text, ASCII other than letters read as blanks, scaled
to length 1.

Families come from ``FAMILIES``; a language that is not listed is a family of
its own.  Training reads a sample of at most about ``PER_LANG`` texts of each
language (``TOTAL`` of all), chosen by a hash of the id; its feature vectors
go to the driver, where the machines are fitted with a squared hinge loss.

Defined cases: a null text, and one without any letter, is ``und`` with score
0; without labelled texts everything is ``und``; with one language it is
always that one; repeated rows are judged each; extra columns are dropped.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM = 1 << 12
PER_LANG, TOTAL = 500, 8000
MOST_LANGS = 256  # languages learned, the most frequent
BLOCK = 1 << 20
#: Languages by family (fixed values).
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
}
LETTER = regex.compile(r"\p{L}")
BLANKED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def text_vector(text: str) -> np.ndarray:
    """Unit vector of the text's hashed trigram counts."""
    data = np.frombuffer(b" " + text.lower().encode().translate(BLANKED) + b" ", np.uint8)
    counts = np.zeros(DIM, np.int64)
    for at in range(0, max(1, len(data) - 2), BLOCK):
        part = data[at : at + BLOCK + 2].astype(np.uint32)
        code = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(0x9E3779B1)
        counts += np.bincount(code >> np.uint32(20), minlength=DIM)
    x = np.sqrt(counts).astype(np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 30.0, rounds: int = 200) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss; y: +1 or -1, both sides weigh the same."""
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, ahead = np.zeros(x1.shape[1], np.float32), np.zeros(x1.shape[1], np.float32)
    rate = 1 / (1 + 4 * cost)  # rows have norm sqrt(2): the gradient's Lipschitz constant is at most this
    momentum = 1.0
    for _ in range(rounds):  # accelerated gradient descent
        slack = np.maximum(0, 1 - y * (x1 @ ahead))
        new = ahead - rate * (ahead - 2 * cost * (x1.T @ (weight * y * slack)))
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead, w, momentum = new + (momentum - 1) / after * (new - w), new, after
    return w


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: list[str]):
        """x: one feature vector per row; langs: their languages."""
        names, labels = sorted(set(langs)), np.array(langs)
        self.members: dict[str, list[str]] = {}
        for name in names:
            self.members.setdefault(family_of(name), []).append(name)
        self.families = sorted(self.members)
        sides = np.array([family_of(n) for n in langs])
        rest = [fit_svm(x, np.where(sides == f, 1.0, -1.0).astype(np.float32)) for f in self.families] if len(self.families) > 1 else [np.zeros(DIM + 1, np.float32)] * len(self.families)
        self.family_weights = np.array(rest).reshape(-1, DIM + 1)
        self.pair_weights: dict[str, np.ndarray] = {}
        for family, members in self.members.items():
            pairs = []
            for a, b in itertools.combinations(members, 2):
                rows = np.isin(labels, (a, b))
                pairs.append(fit_svm(x[rows], np.where(labels[rows] == a, 1.0, -1.0).astype(np.float32)))
            self.pair_weights[family] = np.array(pairs).reshape(-1, DIM + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1): the chance given to the family times that given to the language in it."""
        if not text or not self.families or not LETTER.search(text):
            return "und", 0.0
        x = text_vector(text)
        margins = self.family_weights[:, :-1] @ x + self.family_weights[:, -1]
        best = int(np.argmax(margins))
        family = self.families[best]
        score = 1.0 if len(self.families) == 1 else _chance(float(margins[best] - max(np.delete(margins, best))) / 2)
        members = self.members[family]
        if len(members) == 1:
            return members[0], score
        votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        w = self.pair_weights[family]
        margins = w[:, :-1] @ x + w[:, -1]
        for (a, b), m in zip(itertools.combinations(members, 2), margins.tolist()):
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        lang = min(members, key=lambda n: (-votes[n], -sums[n], n))
        return lang, score * _chance(sums[lang] / (len(members) - 1))


def _chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-4 * margin)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG, total: int = TOTAL) -> LanguageModel:
    """Train on the labelled rows of ``docs``."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    place, digest = F.xxhash64(id_col).alias("place"), F.xxhash64(text_col).alias("digest")
    counts = labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.approx_count_distinct(F.xxhash64(id_col, text_col)).alias("n"))
    counts = {r.lang: max(1, r.n) for r in counts.orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()}
    most = min(per_lang, max(1, total // max(1, len(counts))))
    scale = 1_000_000
    cut = F.lit(0)
    for lang, n in counts.items():
        cut = F.when(F.col(lang_col) == lang, F.lit(-(-most * scale // n))).otherwise(cut)
    # The hash keeps about `most` rows of a language.  Rows that repeat an id and its text count once and each
    # language is bounded by itself, so that repeated ids push nothing out.
    kept = labelled.filter(F.pmod(F.xxhash64(id_col), F.lit(scale)) < cut).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place, digest)
    once = kept.dropDuplicates(["lang", "place", "digest"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("place", "digest"))
    sample = once.withColumn("number", number).filter(F.col("number") <= 2 * most).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([text_vector(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], names=["lang", "x"])

    rows = sample.mapInArrow(run, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, DIM)
    return LanguageModel(x, [r.lang for r in rows])


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` per row."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
