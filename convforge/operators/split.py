"""Seeded, exact-size train / validation split.

The permutation is ``md5(key || ':' || seed)`` order: deterministic,
engine-independent and uniform, so its leading hex digits make skew-free
buckets for the two-level rank in ``operators.ordering``.  ``cut =
floor(n * (1 - val_ratio))`` in double arithmetic (Python's ``int()`` of the
same product); ranks 1..cut are train, the rest validation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convforge.operators.ordering import DEFAULT_HEX_PREFIX, md5_bucket, ranked_running
from convforge.session import materialize
from convforge.schemas import DEFAULT_SEED, DEFAULT_VAL_RATIO

TRAIN = "train"
VAL = "val"


def shuffle_key(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """md5 hex of ``key:seed`` -- the seeded permutation order."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{int(seed)}")))


def assign_split(df: DataFrame, key, val_ratio: float = DEFAULT_VAL_RATIO,
                 seed: int = DEFAULT_SEED, hex_chars: int = DEFAULT_HEX_PREFIX,
                 split_col: str = "split", materialize_input: bool = False) -> DataFrame:
    """Add ``shuffle_rank`` (1..n in permutation order), ``split`` and
    ``split_rank`` (1-based position inside its split, i.e. the row order of
    the written split file).

    ``key`` names the unique, non-NULL key column(s) (their values joined by
    ':' are hashed) or is a Column giving the key text.  Only the keys are ranked --
    small rows through the two-level rank -- and the labels are joined back
    on the key columns, so the example payload is never sorted; when ``df``
    is already partitioned by those columns (e.g. it comes from a grouping
    on them) the payload is not shuffled either.  ``materialize_input``
    computes an expensive ``df`` once: it is read for the keys and for the
    join.
    """
    if not 0.0 <= float(val_ratio) <= 1.0:
        raise ValueError("val_ratio must lie in [0, 1]")
    base = df
    if isinstance(key, Column):
        base = base.withColumn("_split_key", key)
        cols = ["_split_key"]
    else:
        cols = [key] if isinstance(key, str) else list(key)
    if materialize_input:
        base = materialize(base)
    key_text = F.concat_ws(":", *[F.col(c).cast("string") for c in cols])
    ids = base.select(*cols, shuffle_key(key_text, seed).alias("_h"))
    ranked = ranked_running(ids, md5_bucket(F.col("_h"), hex_chars), "_h",
                            rank_col="shuffle_rank", total_col="_n", n_buckets=16 ** hex_chars)
    cut = F.floor(F.col("_n").cast("double") * (F.lit(1.0) - F.lit(float(val_ratio))))
    is_train = F.col("shuffle_rank") <= cut
    labels = ranked.select(
        *cols, "shuffle_rank",
        F.when(is_train, F.lit(TRAIN)).otherwise(F.lit(VAL)).alias(split_col),
        F.when(is_train, F.col("shuffle_rank")).otherwise(F.col("shuffle_rank") - cut)
        .cast("bigint").alias("split_rank"))
    out = base.join(labels, cols)
    return out.drop("_split_key") if isinstance(key, Column) else out


def split_overlap(split_df: DataFrame, content_key: Column, split_col: str = "split") -> DataFrame:
    """Check J2: keys in both splits (duplicates may cross, Q7) and totals.

    Returns one row: n_train, n_val, n_shared_keys.  Two algebraic
    aggregates (per key, then global), so a key repeated in a third of all
    rows is combined map-side like any other.
    """
    per_key = (split_df.groupBy(content_key.alias("_k"))
               .agg(F.count_if(F.col(split_col) == TRAIN).alias("_t"),
                    F.count_if(F.col(split_col) == VAL).alias("_v")))
    return per_key.agg(
        F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("n_train"),
        F.coalesce(F.sum("_v"), F.lit(0)).cast("bigint").alias("n_val"),
        F.count_if((F.col("_t") > 0) & (F.col("_v") > 0)).alias("n_shared_keys"))
