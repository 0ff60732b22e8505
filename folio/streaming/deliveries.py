"""The crosswalk applied to record files as they arrive.

The original processes a delivery folder in one batch.  The same work as a
file stream: new source XML files are picked up by Structured Streaming's
file source (fixed schema, exactly-once file tracking in the checkpoint),
crosswalked, and every micro-batch is written as one upload batch of target
records.  No state is kept between batches - the crosswalk is per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators.crosswalk import SOURCE_SCHEMA, CrosswalkConfig, crosswalk
from ..sources.records import SOURCE_ROW_TAG, write_target_records


def source_stream(spark: SparkSession, in_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("xml").option("rowTag", SOURCE_ROW_TAG).option("ignoreSurroundingSpaces", "false").schema(SOURCE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(in_dir)
    return df.withColumn("record_key", text.record_key(F.col("_metadata.file_path")))


def start_crosswalk_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    cfg: CrosswalkConfig | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the stream; each micro-batch lands in ``out_dir/batch=<id>``, and
    the reasons of values that could not be mapped in ``out_dir/errors/batch=<id>``."""
    records = crosswalk(source_stream(spark, in_dir), cfg, keep=["record_key"])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = out_dir.rstrip("/")
        write_target_records(batch.drop("_errors"), f"{out}/batch={batch_id}")
        bad = batch.filter(F.col("_errors").isNotNull()).select("record_key", "_errors")
        bad.write.mode("overwrite").option("header", "true").csv(f"{out}/errors/batch={batch_id}")

    w = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
