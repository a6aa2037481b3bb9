"""Entropy balancing: mix sources to target token counts.

Each source has a weight; the targets share all words by weight, capped at
``cap`` times the source's own words (excess reshared).  Document rates
``w = min(cap, exp(lambda_s * size / mean size))`` are the closest rates to 1
(in relative entropy, with an upper bound) whose words meet the source's
target; ``lambda_s`` solves the convex dual by Newton steps, guarded by a
bracket.  A rate depends on source and size only, so every step aggregates the
histogram (source, size, documents).  Rates become whole copies by
hash-dithered rounding whose offset per source is then moved until the words
taken meet the target within about one document, and that document is chosen
for the least rest.  DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convforge.llm.common import WORD_RE, attach_small, written

BINS = 1000


def word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_RE)).cast("bigint")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """Target words per source key (one row per source, by code point, null last).

    In ascending order of cap per weight, sources are capped while their cap is
    under the level that the remaining words give the remaining weights.
    """
    s = sizes.groupBy("_key").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_docs"),
                                  F.min(F.when(F.col("_size") > 0, F.col("_size"))).alias("_least"))
    n = len(weights)
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(Window.orderBy("_key")) - 1) % n + 1).cast("int"))
    s = s.withColumn("_w", turn).withColumn("_cap", cap * F.col("source_size").cast("double"))
    order = Window.orderBy((F.col("_cap") / F.col("_w")), "_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("_level", (F.sum("source_size").over(whole)
                                 - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                      / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
          .withColumn("_capped", F.col("_cap") / F.col("_w") < F.col("_level")))
    # The first source that is not capped has the level of all that follow.
    level = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(whole)
    return s.withColumn("target", F.when(F.col("_capped"), F.col("_cap"))
                                   .otherwise(F.least(F.col("_cap"), F.col("_w") * level)))


def solve_rates(hist: DataFrame, targets: DataFrame, cap: int = 3, tol: float = 1e-9,
                max_steps: int = 100) -> DataFrame:
    """Newton steps on the dual, all sources at once; one small state row per source.

    The bracket [lo, hi] holds the root: at lo every rate is at most
    target/size, at hi the smallest document is at the cap.  A step that
    leaves the bracket is replaced by its middle.
    """
    ratio = F.col("target") / F.col("source_size")
    least = F.col("_least") / F.col("_mean")
    state = (targets.withColumn("_mean", F.col("source_size") / F.col("_docs"))
             .withColumn("_open", (F.col("source_size") > 0) & (F.col("target") < F.col("_cap")))
             .withColumn("lo", F.when(F.col("_open"), F.least(F.lit(0.0), F.log(ratio) / least)))
             .withColumn("hi", F.when(F.col("_open"), F.lit(math.log(cap)) / least))
             .withColumn("lam", F.when(F.col("_open"), F.log(ratio)))
             .withColumn("miss", F.when(F.col("_open"), F.lit(1.0)).otherwise(0.0)))
    state = written(state.select("_key", "source_size", "target", "_mean", "_open", "lo", "hi",
                                 "lam", "miss"), "mix-state")
    for _ in range(max_steps):
        x = F.col("_size") / F.col("_mean")
        rate = F.least(F.lit(float(cap)), F.exp(F.col("lam") * x))
        words = F.col("_n") * F.col("_size")
        sums = (attach_small(hist, state.where("_open").select("_key", "_mean", "lam"), "_key")
                .groupBy("_key").agg(
                    F.sum(words * rate).alias("_f"),
                    F.sum(F.when(rate < cap, words * rate * x).otherwise(0.0)).alias("_slope")))
        f = F.col("_f") - F.col("target")
        step = F.col("lam") - f / F.col("_slope")
        lo = F.when(f < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(f < 0, F.col("hi")).otherwise(F.col("lam"))
        done = F.abs(f) <= tol * F.col("target")
        state = written(state.join(sums, "_key", "left").select(
            "_key", "source_size", "target", "_mean", "_open", lo.alias("lo"), hi.alias("hi"),
            F.when(done, F.col("lam"))
             .when((F.col("_slope") > 0) & (step > lo) & (step < hi), step)
             .otherwise((lo + hi) / 2).alias("lam"),
            F.when(F.col("_open") & ~done & (hi - lo > 1e-13), F.abs(f) / F.col("target"))
             .otherwise(0.0).alias("miss")), "mix-state")
        if (state.agg(F.max("miss")).head()[0] or 0.0) <= tol:  # one number
            return state
    raise RuntimeError(f"the dual is not solved after {max_steps} steps")


def _pick(flips: DataFrame, bin_col: str) -> DataFrame:
    """Per key: the bin in which the running words pass ``_need`` and the words
    before it.  At most BINS rows per key enter the window."""
    by = flips.groupBy("_key", "_need", bin_col).agg(F.sum("_size").alias("_words"))
    upto = Window.partitionBy("_key").orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)
    cum = by.withColumn("_cum", F.sum("_words").over(upto))
    return (cum.where(F.col("_cum") > F.col("_need")).groupBy("_key")
               .agg(F.min(F.struct(bin_col, (F.col("_cum") - F.col("_words")).alias("_below"),
                                   "_cum")).alias("_b")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights=(1, 2, 3), cap: int = 3,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Copies of every row of ``docs`` for a mix that meets the sources' targets.

    Returns the id, ``size`` (words; null text: 0), ``source_size``, ``target``,
    ``taken`` (= copies * size), ``rate``, ``copies`` and the columns in ``keep``.
    Null is a source of its own, last in order.  A row without words has rate 1
    and takes nothing; a source at its cap takes every document ``cap`` times.
    Equal rows get equal copies; reruns give equal results.
    """
    carried = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    key = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(
        F.concat(F.lit("0"), F.col(source_col).cast("string")))
    sizes = written(docs.select(F.col(id_col).alias("_id"), key.alias("_key"),
                                word_count(F.col(text_col)).alias("_size"), *carried), "mix-sizes")
    targets = written(source_targets(sizes.select("_key", "_size"), weights, cap), "mix-targets")
    hist = written(sizes.groupBy("_key", "_size").agg(F.count("*").alias("_n")), "mix-hist")
    state = solve_rates(hist, targets, cap)

    # Dithered rounding: floor(rate + u) copies, u uniform by hash of the id.
    u = (F.xxhash64(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_size"))
         .bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    rate = F.when(F.col("_size") == 0, F.lit(1.0)).when(~F.col("_open"), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("_size") / F.col("_mean"))))
    rated = (attach_small(sizes, state.drop("lo", "hi", "miss"), "_key")
             .withColumn("rate", rate).withColumn("_at", F.col("rate") + u)
             .withColumn("_base", F.least(F.lit(cap), F.floor("_at")).cast("bigint")))
    gap = written(rated.groupBy("_key").agg(
        (F.max("target") - F.sum(F.col("_base") * F.col("_size"))).alias("_gap")), "mix-gap")

    # Move the rounding offset: the documents nearest to a flip, in bins of the
    # distance to it and then in bins within the deciding bin.
    far = F.col("_at") - F.floor("_at")
    flips = (attach_small(rated, gap, "_key")
             .withColumn("_up", F.col("_gap") > 0).withColumn("_need", F.abs("_gap"))
             .withColumn("_can", (F.col("_size") > 0) & F.col("_open") & F.when(
                 F.col("_up"), F.col("_base") < cap).otherwise(F.col("_base") > 0))
             .withColumn("_t", F.when(F.col("_up"), 1 - far).otherwise(far) * BINS)
             .withColumn("_b1", F.least(F.lit(BINS - 1), F.floor("_t").cast("int")))
             .withColumn("_b2", F.least(F.lit(BINS - 1), F.floor(
                 (F.col("_t") - F.col("_b1")) * BINS).cast("int"))))
    narrow = flips.where("_can").select("_key", "_size", "_need", "_b1", "_b2")
    first = written(_pick(narrow, "_b1").select("_key", F.col("_b._b1").alias("_c1"),
                                                F.col("_b._below").alias("_below")), "mix-bin1")
    inner = (attach_small(narrow, first, "_key").where(F.col("_b1") == F.col("_c1"))
             .withColumn("_need", F.col("_need") - F.col("_below")))
    # Include the deciding inner bin when that ends nearer to the target.
    second = _pick(inner, "_b2").join(inner.groupBy("_key").agg(F.max("_need").alias("_rest")), "_key")
    second = second.select("_key", F.when(
        F.col("_b._cum") - F.col("_rest") < F.col("_rest") - F.col("_b._below"),
        F.col("_b._b2")).otherwise(F.col("_b._b2") - 1).alias("_c2"))
    cut = written(first.drop("_below").join(second, "_key"), "mix-cut")
    flip = F.col("_can") & (F.col("_c1").isNull() | (F.col("_b1") < F.col("_c1"))
                            | ((F.col("_b1") == F.col("_c1")) & (F.col("_b2") <= F.col("_c2"))))
    copies = F.col("_base") + F.when(flip, F.when(F.col("_up"), 1).otherwise(-1)).otherwise(0)
    rounded = (attach_small(flips, cut, "_key", "left")
               .select("_id", "_key", "_size", "source_size", "target", "_open", "rate",
                       copies.cast("bigint").alias("_copies"), *[f"_keep_{i}" for i in range(len(keep))]))

    # What is left of a source's gap: the one document that closes most of it
    # (equal rows move together).
    left = written(rounded.groupBy("_key").agg(
        (F.max("target") - F.sum(F.col("_copies") * F.col("_size"))).alias("_left")), "mix-left")
    movable = F.when(F.col("_left") > 0, F.col("_copies") < cap).otherwise(F.col("_copies") > 0)
    best = (attach_small(rounded, left, "_key").where((F.col("_size") > 0) & F.col("_open") & movable)
            .groupBy("_key", "_left", "_id", "_size").agg(F.sum("_size").alias("_words"))
            .withColumn("_miss", F.abs(F.abs("_left") - F.col("_words")))
            .where(F.col("_miss") < F.abs("_left"))
            .groupBy("_key", "_left").agg(F.min(F.struct("_miss", "_id", "_size")).alias("_b"))
            .select("_key", F.when(F.col("_left") > 0, 1).otherwise(-1).alias("_move"),
                    F.col("_b._id").alias("_best_id"), F.col("_b._size").alias("_best_size")))
    moved = F.col("_copies") + F.when(F.col("_id").eqNullSafe(F.col("_best_id"))
                                      & (F.col("_size") == F.col("_best_size")), F.col("_move")).otherwise(0)
    return (attach_small(rounded, written(best, "mix-best"), "_key", "left")
            .withColumn("copies", moved.cast("bigint"))
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size",
                    "target", (F.col("copies") * F.col("_size")).cast("bigint").alias("taken"),
                    "rate", "copies", *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]))
