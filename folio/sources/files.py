"""File manifests, authority lists, document text and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

# --- fixed values -----------------------------------------------------------
KIND_BY_EXTENSION = {"xml": "xml", "pdf": "pdf"}
MEDIA_KIND = "media"
# ---------------------------------------------------------------------------


def file_kind(path: Column) -> Column:
    """``xml`` / ``pdf`` by extension (case-insensitive), else ``media``
    (supplementary files and folders of a delivery)."""
    ext = F.lower(F.regexp_extract(text.basename(path), "\\.([^.]*)\\z", 1))
    out = F.lit(MEDIA_KIND)
    for e, k in reversed(list(KIND_BY_EXTENSION.items())):
        out = F.when(ext == e, F.lit(k)).otherwise(out)
    return out


def manifest_from_paths(paths: DataFrame, path_col: str = "path", keep: list[str] | None = None) -> DataFrame:
    """Classify delivered files: ``keep..., path, name, kind, record_key``."""
    p = F.col(path_col)
    return paths.select(
        *[F.col(k) for k in (keep or [])],
        p.alias("path"),
        text.basename(p).alias("name"),
        file_kind(p).alias("kind"),
        text.record_key(p).alias("record_key"),
    )


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    """List a delivery folder (recursively) without reading file contents."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.col("path"), F.col("length"))
    )
    return manifest_from_paths(files, keep=["length"])


def record_completeness(manifest: DataFrame) -> DataFrame:
    """Per record: does it have its XML and its PDF, how many media files."""
    return manifest.groupBy("record_key").agg(
        F.bool_or(F.col("kind") == "xml").alias("has_xml"),
        F.bool_or(F.col("kind") == "pdf").alias("has_pdf"),
        F.sum(F.when(F.col("kind") == MEDIA_KIND, 1).otherwise(0)).cast("long").alias("n_media"),
    )


def read_authority_csv(spark: SparkSession, path: str) -> DataFrame:
    """Authority list: one name per line, quoted commas, no header.  Keeps
    the list position (``ord``) because ties go to the earlier entry."""
    df = spark.read.schema("authority_name string").option("header", "false").csv(path)
    return df.withColumn("ord", F.monotonically_increasing_id())


def document_text(pages: DataFrame, max_pages: int = 11) -> DataFrame:
    """``(record_key, page_no, text)`` -> ``(record_key, text)``: the first
    ``max_pages`` pages in page order, concatenated.  Of rows that repeat a
    page the least text counts, so a record's group holds at most
    ``max_pages`` rows."""
    first = pages.filter(F.col("page_no") < max_pages).groupBy("record_key", "page_no").agg(F.min("text").alias("text"))
    return first.groupBy("record_key").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"]),
            "",
        ).alias("text")
    )


def write_error_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Error report as CSV with a header (one part file per task); values keep their blanks."""
    w = df.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    w.mode(mode).csv(path)
