"""Record files: XML source records in, XML target batches out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.crosswalk import SOURCE_SCHEMA
from ..operators.ordering import ordered_batches
from ..session import written

SOURCE_ROW_TAG = "DISS_submission"
# --- fixed value: the namespace of the target's xsi: attributes --------------
SCHEMA_INSTANCE = "http://www.w3.org/2001/XMLSchema-instance"
# -----------------------------------------------------------------------------


CORRUPT = "_corrupt_record"


def read_source_records(spark: SparkSession, path: str, schema: str = SOURCE_SCHEMA, row_tag: str = SOURCE_ROW_TAG) -> DataFrame:
    """Scan a folder (or glob) of source XML records with a fixed schema.

    Adds ``path`` (the file), ``record_key`` (``text.record_key``) and
    ``_corrupt_record``: the text of a record that cannot be parsed, else
    NULL.  Surrounding blanks are kept: the crosswalk normalises them itself.
    ``accepted_and_rejects`` tells good records from the others."""
    df = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(f"{schema}, {CORRUPT} string")
        .load(path)
    )
    return df.withColumn("path", F.col("_metadata.file_path")).withColumn("record_key", text.record_key(F.col("path")))


# Reasons for which a file or record is rejected.
MALFORMED, EMPTY, NO_RECORD = "malformed record", "empty record", "no record"


def accepted_and_rejects(spark: SparkSession, folder: str, schema: str = SOURCE_SCHEMA, row_tag: str = SOURCE_ROW_TAG, delivered: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The records of a folder that can be used, and ``path, record_key, reason,
    content`` of what cannot.

    A record is rejected if it does not parse (its file is not read beyond) or
    has none of the schema's elements; a file is rejected if no record is found
    in it.  Every file of the folder thus gives a record or a reject.  Spark's
    scans skip files without a byte: give ``delivered`` (column ``path``) to
    have them rejected too, by their record key."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    scanned = written(read_source_records(spark, folder, schema, row_tag), "scanned")
    filled = F.greatest(*[F.col(n).isNotNull() for n in names], F.lit(False))
    reason = F.when(F.col(CORRUPT).isNotNull(), MALFORMED).when(~filled, EMPTY)
    good = scanned.filter(reason.isNull()).drop(CORRUPT)
    bad = scanned.filter(reason.isNotNull()).select("path", "record_key", reason.alias("reason"), F.col(CORRUPT).alias("content"))
    silent = lambda files, seen, by: files.join(seen, by, "left_anti").select("path", "record_key", F.lit(NO_RECORD).alias("reason"), F.lit(None).cast("string").alias("content"))
    path = F.col("_metadata.file_path")
    files = spark.read.format("binaryFile").load(folder).select(path.alias("path"), text.record_key(path).alias("record_key"))
    out = bad.unionByName(silent(files, scanned.select("path").distinct(), "path"))
    if delivered is not None:
        known = files.select("record_key").distinct()
        out = out.unionByName(silent(delivered.select("path", text.record_key("path").alias("record_key")).distinct(), known, "record_key"))
    return good, out


def write_target_records(
    df: DataFrame, path: str, batch_col: str | None = None, mode: str = "overwrite", max_records_per_file: int = 500_000, schema_location: str | None = None
) -> None:
    """Write target records as ``<documents><document>…</document></documents>``.

    With ``batch_col`` every upload batch gets its own folder
    (``batch_col=<value>``); each task writes its share of each batch, so a
    batch holding a third of all records is still written by many tasks.
    Files are split at ``max_records_per_file`` records.  Nothing funnels
    through a single task.  ``schema_location`` is the target system's schema
    URL, written on the root element."""
    root = f"documents xmlns:xsi='{SCHEMA_INSTANCE}'" + (f" xsi:noNamespaceSchemaLocation='{schema_location}'" if schema_location else "")
    w = (
        df.write.format("xml")
        .option("rootTag", root)
        .option("rowTag", "document")
        .option("validateName", "false")  # names with a prefix, as xsi:type
        .option("declaration", 'version="1.0" encoding="UTF-8" standalone="yes"')
        .option("maxRecordsPerFile", str(max_records_per_file))
        .mode(mode)
    )
    if batch_col is not None:
        w = w.partitionBy(batch_col)
    w.save(path)


def read_target_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.format("xml").option("rowTag", "document").option("ignoreSurroundingSpaces", "false")
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def merge_batches(frames: list[DataFrame], sort_by_name: bool = False, skip: int = 0, order_col: str = "record_key") -> DataFrame:
    """Union all target records of several folders into one batch.

    ``sort_by_name`` orders by the first author's last and first name.
    ``skip`` drops the first ``skip`` records (rows, not keys) in the order
    of ``order_col``, then of the other columns, which must be orderable (the
    original loop skipped a fixed number of left-over files)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if skip:
        # The first rows come from a bounded top-k.  Only rows that share a
        # key with them (at most ``skip`` keys, so a broadcast is bounded by
        # the parameter) are compared as rows; equal rows are interchangeable.
        columns = [order_col, *(c for c in out.columns if c != order_col)]
        first = out.orderBy(*columns).limit(skip)
        keys = F.broadcast(first.select(F.col(order_col).alias("__first")).distinct())
        same = F.col(order_col).eqNullSafe(F.col("__first"))
        out = out.join(keys, same, "left_anti").unionByName(out.join(keys, same, "left_semi").exceptAll(first))
    if sort_by_name:
        first = F.get(F.col("authors.author"), 0)  # records without an author come first
        out = out.orderBy(first["lname"], first["fname"])
    return out


BY_NAME = ("lname", "fname")


def upload_batches(records: DataFrame, size: int, key: str = "record_key") -> DataFrame:
    """Records by the first author's last and first name, then by key and title, cut into
    batches of exactly ``size``: adds ``batch`` and ``position``.  Records without an author come first."""
    first = F.get(F.col("authors.author"), 0)
    return ordered_batches(records, [*(first[c] for c in BY_NAME), F.col(key), F.col("title")], size)


def write_upload_batches(batches: DataFrame, path: str, schema_location: str | None = None) -> None:
    """Each batch as one file of target records in order, in ``path/batch=<n>``; a batch is written by one task, as its size is fixed."""
    dealt = batches.repartitionByRange("batch").sortWithinPartitions("batch", "position").drop("position")
    write_target_records(dealt, path, batch_col="batch", max_records_per_file=0, schema_location=schema_location)
