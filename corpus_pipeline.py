"""Corpus pipeline: five stages applied to ``documents`` one after another.

Each stage takes all rows that its predecessor kept; all but the last return
the columns of ``documents``.  The lists of documents to keep grow with the
input, so they are merge-joined at every size and never broadcast.

Defined cases of all stages: null texts count as empty (packing gives them
their end token, the others leave them null); null and repeated ids, repeated
rows and empty tables are allowed, and so are further columns of any name,
which are kept; the two de-duplications keep one row of each group, also where
its rows share an id or have none.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import pii, toxicity
from folio.llm.common import WRITTEN, materialise, release, table
from folio.llm.cuckoo import exact_groups
from folio.llm.packing import pack_documents
from folio.llm.simhash import near_components

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, learned from ``labels``, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def _the_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names (chosen_id, chosen_sha256, and the ``times`` they are there), once
    each: of rows that repeat an id and text the least in all columns."""
    d, k = docs.alias("d"), lambda rows: rows.hint("merge").alias("k")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.chosen_id")) & (F.sha2(F.coalesce("d.text", F.lit("")), 256) == F.col("k.chosen_sha256"))
    if chosen.filter("times > 1").isEmpty():
        return d.join(k(chosen), same, "left_semi")
    once = d.join(k(chosen.filter("times = 1")), same, "left_semi")
    row = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns])
    several = d.join(k(chosen.filter("times > 1")), same).groupBy("k.chosen_id", "k.chosen_sha256").agg(F.min(row).alias("least"))
    return once.unionByName(several.select("least.*"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of the largest id; of rows that repeat its id, the least in all columns."""
    kept = exact_groups(docs).filter("kept")
    return _the_rows(docs, materialise(kept.groupBy(F.col("doc_id").alias("chosen_id"), F.col("text_sha256").alias("chosen_sha256")).agg(F.count(F.lit(1)).alias("times")), "kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: of its smallest id (a null id is larger than any), and of that id's texts the one of the least SHA-256."""
    found = materialise(near_components(docs, digest=True).select("root", "doc_id", "sha256"), "near")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("odd"), "doc_id", "sha256")).alias("f")).select(F.col("f.doc_id").alias("chosen_id"), F.col("f.sha256").alias("chosen_sha256"))
    n = found.groupBy("doc_id", "sha256").agg(F.count(F.lit(1)).alias("times"))
    chosen = first.join(n, F.col("chosen_id").eqNullSafe(F.col("doc_id")) & (F.col("chosen_sha256") == F.col("sha256"))).select("chosen_id", "chosen_sha256", "times")
    return _the_rows(docs, materialise(chosen, "kept"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each personal-data span replaced by its kind; ``n_chars`` follows the text."""
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' ids packed into windows of 2048, one row per piece."""
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack),
]

#: The learned stages cannot be said in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again by the next; what a stage
    wrote on its way goes once its result is stored, and a result goes once the next one is."""
    docs = table(spark, sf_dir, "documents")
    first = len(WRITTEN)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        release(spark, first, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
