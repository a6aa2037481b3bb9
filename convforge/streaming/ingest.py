"""Incremental ingest of new JSONL files with Structured Streaming.

Every rule is row-local, so the stream is stateless: each micro-batch of new
files is validated and appended to two tables, accepted conversations and
rejects.  A file is always processed whole inside one micro-batch, so
object numbering within a file is the same as in the batch job.

Exactly-once output: ``foreachBatch`` writes each batch into its own
``batch_id=N`` directory with overwrite, so a batch replayed after a failure
replaces its earlier attempt instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.operators import validate as va
from convforge.plans.prepare import validate_jsonl_lines
from convforge.session import write_through
from convforge.sources.raw import readable, relative_name


KEYS = ["file_path", "file_name", "object_index", "line_no"]


def _batch_writer(output_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch is a static scan of whole files, so numbering matches the
        # batch job (same rules, same function).  The numbered rows are written
        # once; both tables are cut from them.
        v = write_through(validate_jsonl_lines(batch), "stream-batch")
        (va.accepted(v, KEYS).write.mode("overwrite")
         .parquet(f"{output_dir}/accepted/batch_id={batch_id}"))
        (va.rejected(v, KEYS).write.mode("overwrite")
         .parquet(f"{output_dir}/rejected/batch_id={batch_id}"))
    return write


def start_ingest(spark: SparkSession, source_dir: str, output_dir: str,
                 checkpoint_dir: str, glob: str = "*.jsonl",
                 max_files_per_trigger: int | None = None,
                 available_now: bool = True):
    """Start the stream; returns the StreamingQuery.

    With ``available_now`` the query processes every file present and stops
    (``awaitTermination()``); otherwise it polls for new files.
    """
    reader = (spark.readStream.format("text")
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir).select(
        F.col("_metadata.file_path").alias("file_path"),
        relative_name(spark, source_dir).alias("file_name"),
        F.col("_metadata.file_block_start").alias("_blk"),
        readable("value").alias("value"))
    w = (lines.writeStream.foreachBatch(_batch_writer(output_dir))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def accepted_conversations(spark: SparkSession, output_dir: str) -> DataFrame:
    """Accepted conversations of all batches: their keys and messages."""
    return spark.read.parquet(f"{output_dir}/accepted")


def rejected_values(spark: SparkSession, output_dir: str) -> DataFrame:
    """Rejected values of all batches: their keys, reason, bad_index and value."""
    return spark.read.parquet(f"{output_dir}/rejected")
