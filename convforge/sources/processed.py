"""Processed split files and query tables.

Split files hold one compact JSON object ``{"messages": [...]}`` per line.
They are written as a directory of part files in dataset order (range
partitioned on the order key, sorted within each part), and read back with
a declared schema -- never inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convforge.operators.joins import lookup_small
from convforge.schemas import CONV_FILE
from convforge.session import write_through
from convforge.sources.raw import _path_exists, number_within_file, relative_name


def write_jsonl(conv: DataFrame, path: str, order: str | None = None,
                messages: str = "messages", num_files: int | None = None) -> None:
    """Overwrite ``path`` with one JSON object per line, non-ASCII kept.

    With ``order`` the part files follow that order (range partitioning, so
    no single task sorts everything); reading them back in file-name order
    restores the dataset order.
    """
    out = conv.select(*([order] if order else []),
                      F.to_json(F.struct(F.col(messages).alias("messages"))).alias("value"))
    if order:
        out = (out.repartitionByRange(num_files, order) if num_files
               else out.repartitionByRange(order))
        out = out.sortWithinPartitions(order).select("value")
    elif num_files:
        out = out.repartition(num_files)
    out.write.mode("overwrite").text(path)


def read_processed(spark: SparkSession, path: str, with_order: bool = True) -> DataFrame:
    """A split directory or file -> (file_name, line_index, messages).

    ``file_name`` (relative to ``path``) + ``line_index`` give the dataset order
    (part files are named in write order).  Returns None when the path does not exist, so a
    missing validation split just disables validation.
    """
    if not _path_exists(spark, path):
        return None
    df = spark.read.schema(CONV_FILE).json(path)
    if not with_order:
        return df
    df = df.select(F.col("_metadata.file_path").alias("file_path"),
                   relative_name(spark, path).alias("file_name"),
                   F.col("_metadata.file_block_start").alias("_blk"), "messages")
    return (number_within_file(df, file_col="file_path", out="line_index")
            .select("file_name", "line_index", "messages"))


def dataset_order(split: DataFrame, out: str = "example") -> DataFrame:
    """Add a 1-based dataset position from (file, line) order.

    Files are ordered by folder, part number (as Spark numbers its part files)
    and name.  Lines are numbered from 0 within their file already, so only the
    files' row counts are summed up, one narrow row per file; no row is sorted.
    """
    folder = F.regexp_extract("file_name", r"^(.*/)?[^/]*$", 1)
    part = F.coalesce(F.regexp_extract("file_name", r"part-(\d+)[^/]*$", 1).try_cast("bigint"), F.lit(-1))
    before = Window.orderBy(folder, part, "file_name").rowsBetween(Window.unboundedPreceding, -1)
    counts = split.groupBy("file_name").agg(F.count(F.lit(1)).alias("_n"))
    offsets = write_through(counts.select(
        "file_name", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")), "file-offsets")
    return (lookup_small(split, offsets, ["file_name"])
            .withColumn(out, F.col("_off") + F.col("line_index") + 1).drop("_off"))


def query_table(spark: SparkSession, queries, column: str = "query") -> DataFrame:
    """A literal list of queries (or one query) as a table."""
    if isinstance(queries, str):
        queries = [queries]
    return spark.createDataFrame([(i, q) for i, q in enumerate(queries)],
                                 f"query_id bigint, {column} string")


def write_report(report: DataFrame, path: str) -> None:
    """Report lines (pos, sub, value) as one JSON text file.  The rows pass
    through one sorting task one by one; they are never gathered in a value."""
    (report.repartition(1).sortWithinPartitions("pos", "sub").select("value")
     .write.mode("overwrite").text(path))
