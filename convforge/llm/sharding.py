"""Contiguous, byte-balanced shards from two-level prefix sums.

Rows are range-partitioned by id.  Every partition's byte and row totals (one
small row each) are prefix-summed; a row's global byte position is its
partition's offset plus the running sum inside the partition.  The line of all
bytes is cut into ``n_shards`` equal targets; a row belongs to the shard that
holds its midpoint, so a shard differs from its target by less than the
largest row.  Only sizes and checksums are sorted; texts move once, when the shards
are known.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convforge.llm.common import written


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id",
                   text_col: str = "text", overhead: int = 8,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Assign every row of ``docs`` to one of ``n_shards`` contiguous shards.

    Size of a row: UTF-8 bytes of its text (null: none) plus ``overhead``.
    Order: id (null first), then crc32 and size of the text; identical rows are
    interchangeable.  Returns the id, ``size``, ``text_crc32`` (null text: as
    empty), ``law``, ``shard``, ``slot`` (gapless from 0 within its shard),
    ``grown_shard`` (null: this law has no key) and the columns in ``keep``.
    Fewer rows than shards leave shards empty; no rows give no rows.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # What is kept (texts) moves once, at the end; a row knows it by its content.
    kept = [f"_keep_{i}" for i in range(len(keep))]
    base = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("_size"),
        F.crc32(text).alias("_crc"),
        *([F.xxhash64(*keep).alias("_a"), F.xxhash64(F.lit(1), *keep).alias("_b")] if keep else []),
        *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    # The partition number is written with the rows, so every later step (and
    # a retried task) sees the same partitioning.  The last part of the order
    # lets equal rows fall into several partitions.
    order = ["_id", "_crc", "_size", "_tie"]
    narrow = base.drop(*kept).withColumn("_tie", F.monotonically_increasing_id())
    narrow = written(narrow.repartitionByRange(parts, *order)
                           .withColumn("_part", F.spark_partition_id()), "shard-rows")

    # One row per partition: bounded by the number of partitions.
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (narrow.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
                   .select("_part",
                           F.coalesce(F.sum("_bytes").over(upto), F.lit(0)).alias("_byte0"),
                           F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_row0"),
                           F.sum("_bytes").over(Window.orderBy("_part").rowsBetween(
                               Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total")))
    offsets = written(offsets, "shard-offsets")

    inside = Window.partitionBy("_part").orderBy(*order)
    run = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = (narrow.withColumn("_seq", F.row_number().over(inside) - 1)
                .withColumn("_before", F.coalesce(F.sum("_size").over(run), F.lit(0)))
                .join(F.broadcast(offsets), "_part")
                .withColumn("_row", F.col("_row0") + F.col("_seq"))
                .withColumn("_twice", 2 * (F.col("_byte0") + F.col("_before")) + F.col("_size"))
                # floor(midpoint * n_shards / total); exact in decimals at any size
                .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(
                    f"cast(_twice as decimal(28,0)) * {int(n_shards)} div (2 * cast(_total as decimal(28,0)))"
                ).cast("int"))))
    firsts = rows.groupBy("shard").agg(F.min("_row").alias("_first"))  # at most n_shards rows
    out = (rows.join(F.broadcast(firsts), "shard")
               .select("_id", "_size", "_crc", *(["_a", "_b"] if keep else []), F.lit("bytes").alias("law"), "shard",
                       (F.col("_row") - F.col("_first")).cast("bigint").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard")))
    if keep:
        # Rows equal in id and content are one row here, and get all their slots back.
        same = ["_null", "_id0", "_crc", "_a", "_b"]

        def keyed(df):
            return df.withColumns({"_null": F.col("_id").isNull(), "_id0": F.coalesce(F.col("_id").cast("string"), F.lit(""))})
        once = keyed(base).groupBy(*same).agg(F.first(F.struct(*kept)).alias("_kept"))
        out = keyed(out).join(once, same).select("*", "_kept.*")
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                      "law", "shard", "slot", "grown_shard", *[F.col(k).alias(c) for c, k in zip(keep, kept)])
