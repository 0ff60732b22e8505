"""Records and documents paired as their files arrive.

Two streams, the XML records and the PDF documents of a delivery, meet in a
full outer join on the record key within ``delay`` of each other.  Both sides
are kept as state until the watermark passes, so a pair is emitted when its
second file arrives, and a file that stayed alone once it can no longer be
paired: late partners do not find it.  Watermark and state are in the
checkpoint, so a stream that was stopped goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import manifest_from_paths

ARRIVALS = "path string, arrived timestamp"


def arrivals(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of delivery notes (Parquet, ``path`` and ``arrived``)."""
    r = spark.readStream.schema(ARRIVALS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(folder)


def pair_files(notes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``record_key, xml_path, pdf_path, side`` of the stream ``notes``: ``pair``,
    ``record_without_document`` or ``document_without_record``.

    Files of one record that arrive within ``delay`` pair, each with each;
    media files take no part; a note without an arrival time is left out."""
    n = manifest_from_paths(notes.filter(F.col("arrived").isNotNull()), keep=["arrived"])

    def side(kind: str, tag: str) -> DataFrame:
        rows = n.filter(F.col("kind") == kind).select(F.col("record_key").alias(f"{tag}_key"), F.col("path").alias(f"{tag}_path"), F.col("arrived").alias(f"{tag}_at"))
        return rows.withWatermark(f"{tag}_at", delay)

    near = f"xml_key = pdf_key AND pdf_at >= xml_at - INTERVAL {delay} AND pdf_at <= xml_at + INTERVAL {delay}"
    j = side("xml", "xml").join(side("pdf", "pdf"), F.expr(near), "full_outer")
    what = F.when(F.col("pdf_key").isNull(), "record_without_document").when(F.col("xml_key").isNull(), "document_without_record").otherwise("pair")
    return j.select(F.coalesce("xml_key", "pdf_key").alias("record_key"), "xml_path", "pdf_path", what.alias("side"))


def start_pairing(spark: SparkSession, folder: str, out_dir: str, checkpoint_dir: str, delay: str = "1 hour", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Read what there is and stop; the next start goes on from there."""
    pairs = pair_files(arrivals(spark, folder, max_files_per_trigger), delay)
    w = pairs.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint_dir)
    return w.outputMode("append").trigger(availableNow=True).start()
