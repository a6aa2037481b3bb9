"""Skew-aware lookup join (J3 and the scorer's vocabulary lookup).

``big`` has many rows per key and may be heavily skewed (one token can be a
third of all tokens); ``small`` has at most one row per key plus a
frequency column.  Keys whose frequency reaches ``total / max_hot`` are
*hot*: fewer than ``max_hot`` keys can reach that share, so the hot-key list
has a proven size bound and is broadcast.  Rows of ``big`` with a hot key get
a salt in ``[0, salt_buckets)`` from a hash of the row (deterministic, so a
recomputed task produces the same rows); the matching rows of ``small`` are
replicated once per salt -- at most ``max_hot * salt_buckets`` extra rows.
One shuffle join on ``(key, salt)`` then spreads every hot key over
``salt_buckets`` tasks while cold keys (each below ``total / max_hot``) stay
as they are.  AQE skew-join remains on for keys that are hot in ``big`` but
rare in ``small``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_HOT = 50_000
DEFAULT_SALT_BUCKETS = 32


def skew_aware_lookup(big: DataFrame, small: DataFrame, key: str, weight: str,
                      total_weight: float, how: str = "left",
                      max_hot: int = DEFAULT_MAX_HOT,
                      salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """``big JOIN small USING (key)`` with hot keys salted.

    ``total_weight`` is ``sum(small[weight])`` (a scalar the caller already
    has).  ``how`` is 'left' or 'inner'.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    threshold = max(float(total_weight) / float(max_hot), 1.0)
    # Fewer than max_hot keys can reach the threshold: a bounded broadcast.
    hot = F.broadcast(small.where(F.col(weight) >= F.lit(threshold))
                      .select(key, F.lit(True).alias("_hot")))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    salted_big = (big.join(hot, key, "left")
                  .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(salt_buckets)))
                              .otherwise(F.lit(0)).cast("int"))
                  .drop("_hot"))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
    salted_small = (small.join(hot, key, "left")
                    .withColumn("_salt", F.explode(salts)).drop("_hot"))
    return salted_big.join(salted_small, [key, "_salt"], how).drop("_salt")


def attach_results(examples: DataFrame, results: DataFrame, keys) -> DataFrame:
    """Attach externally produced results (scores, generations) to the
    examples they belong to, keyed by the examples' unique key columns.

    A left join: examples without a result keep NULLs.  Both sides have one
    row per key, so no key can be skewed; AQE picks broadcast or shuffle by
    the measured size of ``results``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    extra = [c for c in results.columns if c not in keys]
    return examples.join(results.select(*keys, *extra), keys, "left")


def lookup_small(big: DataFrame, small: DataFrame, keys, how: str = "inner",
                 max_rows: int = 500_000) -> DataFrame:
    """Join a narrow, already written table: broadcast when its counted rows are
    within ``max_rows``, else a shuffle join."""
    if small.limit(max_rows + 1).count() <= max_rows:
        small = F.broadcast(small)
    return big.join(small, keys, how)
