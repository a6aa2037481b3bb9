"""Global rank and running sums without a single-partition window.

A window ``ORDER BY k`` with no ``PARTITION BY`` sorts the whole table in one
task.  Here the order key is coarsened into buckets that preserve its order
(``bucket(a) < bucket(b)  =>  a < b``):

1. count rows (and sum the running columns) per bucket -- a map-side
   combined aggregate whose result has at most ``n_buckets`` rows;
2. prefix-sum that small table;
3. join it on the bucket and add each bucket's offset to a window
   partitioned by bucket.

Each bucket is sorted independently, so the work spreads over all tasks.
Buckets must not be skewed: derive them from a hash (``md5_bucket``) or from
an evenly spaced numeric key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convforge.session import materialize

# 16**4 buckets: ample parallelism for 1e10 rows (about 150k rows a bucket)
# and a broadcast table of at most 65,536 small rows.
DEFAULT_HEX_PREFIX = 4
MAX_BUCKETS = 1 << 20


def md5_bucket(hash_hex: Column, hex_chars: int = DEFAULT_HEX_PREFIX) -> Column:
    """Order-preserving bucket of an md5 hex string: its first hex digits."""
    if not 1 <= hex_chars <= 5:
        raise ValueError("hex_chars must be within 1..5")
    # Never NULL for a hex string; coalesce makes that visible to the
    # optimizer, so no extra filter is inferred and the input subtree is the
    # same on both sides of the offset join (its exchange is reused).
    return F.coalesce(F.conv(F.substring(hash_hex, 1, hex_chars), 16, 10).cast("int"), F.lit(0))


def ranked_running(df: DataFrame, bucket: Column, order, sums=(),
                   rank_col: str = "rank", total_col: str | None = None,
                   n_buckets: int = 1 << (4 * DEFAULT_HEX_PREFIX),
                   materialize_input: bool = False) -> DataFrame:
    """Add a global 1-based ``rank`` in ``order`` and inclusive running sums.

    ``order`` (column name or list) must totally order rows and agree with
    ``bucket``.  For every name in ``sums`` a column ``run_<name>`` is added.
    ``total_col`` optionally adds the overall row count.  The input is read
    twice (bucket totals, then the rows); ``materialize_input`` computes an
    expensive input once into the shared checkpoint folder first.
    """
    if n_buckets > MAX_BUCKETS:
        raise ValueError("too many buckets for one ordered offset table")
    order = [order] if isinstance(order, str) else list(order)
    sums = list(sums)
    b = df.withColumn("_bkt", bucket)
    if materialize_input:
        b = materialize(b)

    per_bucket = b.groupBy("_bkt").agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.sum(c).alias(f"_s_{c}") for c in sums])
    # The offset table has one row per non-empty bucket (<= n_buckets), so a
    # single ordered window over it is cheap.
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = per_bucket.select(
        "_bkt",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *([F.sum("_cnt").over(everything).alias("_total")] if total_col else []))

    within = Window.partitionBy("_bkt").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The window needs the rows by bucket anyway: the join shares that shuffle, or
    # AQE broadcasts the offsets by their measured size.
    out = (b.join(offsets, "_bkt")
           .withColumn(rank_col, (F.col("_off") + F.row_number().over(within)).cast("bigint")))
    for c in sums:
        out = out.withColumn(f"run_{c}", F.col(f"_o_{c}") + F.sum(c).over(upto))
    if total_col:
        out = out.withColumnRenamed("_total", total_col)
    return out.drop("_bkt", "_off", *[f"_o_{c}" for c in sums])


def exclusive_sums(blocks: DataFrame, partition: list[str], block: str, sums: list[str],
                   fan: int = 10_000, levels: int = 2) -> DataFrame:
    """Sums of all blocks before each one, within its ``partition`` group.

    ``blocks`` has one row per group and block number, with a column ``_s_<name>`` per
    name in ``sums``; ``_o_<name>`` is added.  The table itself may be too large for
    one task: at every level but the last, blocks are gathered ``fan`` numbers at a
    time, the sums before a gathered block are found one level up, and each is
    summed up on its own.  The last level orders a group's remaining rows in one
    task: a ``fan ** (levels - 1)``-th of the group's blocks.
    """
    def before(by):
        return Window.partitionBy(*by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)

    def until(by):
        return {f"_o_{c}": F.coalesce(F.sum(f"_s_{c}").over(before(by)), F.lit(0)) for c in sums}

    if levels <= 1:
        return blocks.withColumns(until(partition))
    up = blocks.withColumn("_up", F.expr(f"{block} div {int(fan)}"))
    gathered = (up.groupBy(*partition, "_up").agg(*[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sums])
                .withColumnRenamed("_up", block))
    above = exclusive_sums(gathered, partition, block, sums, fan, levels - 1).select(
        *partition, F.col(block).alias("_up"), *[F.col(f"_o_{c}").alias(f"_above_{c}") for c in sums])
    return (up.withColumns(until([*partition, "_up"])).join(above, [*partition, "_up"])
            .withColumns({f"_o_{c}": F.col(f"_o_{c}") + F.col(f"_above_{c}") for c in sums})
            .drop("_up", *[f"_above_{c}" for c in sums]))


def running_within(df: DataFrame, partition, order, block: Column, sums,
                   prefix: str = "run_", materialize_input: bool = False,
                   fan: int = 10_000, levels: int = 2) -> DataFrame:
    """Inclusive running sums of ``sums`` inside each ``partition`` group (no
    partition: over the whole table).

    Same idea as ``ranked_running`` but per group: ``block`` is an
    order-preserving whole-number coarsening of ``order`` inside a group (e.g.
    ``line_no div 10000``).  Per-block totals (one row per block) are summed up per
    group in ``levels`` levels of ``fan`` (``exclusive_sums``); each block is then summed on its own, so one enormous group is
    spread over all of its blocks instead of one task.  The block offsets
    are joined back with an equi-join (AQE broadcasts them when small).
    """
    partition = [partition] if isinstance(partition, str) else list(partition)
    order = [order] if isinstance(order, str) else list(order)
    sums = list(sums)
    b = df.withColumn("_blk2", block)
    if materialize_input:
        b = materialize(b)
    per_block = b.groupBy(*partition, "_blk2").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    offsets = exclusive_sums(per_block, partition, "_blk2", sums, fan, levels).drop(*[f"_s_{c}" for c in sums])
    within = (Window.partitionBy(*partition, "_blk2").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = b.join(offsets, [*partition, "_blk2"])
    for c in sums:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_o_{c}") + F.sum(c).over(within))
    return out.drop("_blk2", *[f"_o_{c}" for c in sums])
