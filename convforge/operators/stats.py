"""Corpus statistics and audits.

Statistics are sums over a per-conversation profile (see
``operators.validate``), so the whole computation is one global aggregate
whose partial sums are combined map-side: the shuffle moves one row per
partition regardless of corpus size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.functions.text import pretty_key, thousands
from convforge.schemas import CHARS_PER_TOKEN, STATS_COLUMNS


def stat_exprs():
    z = F.lit(0).cast("bigint")
    chars = F.coalesce(F.sum("n_chars"), z)
    return [
        F.count(F.lit(1)).alias("conversations"),
        F.coalesce(F.sum("n_messages"), z).alias("total_turns"),
        F.coalesce(F.sum("n_system"), z).alias("system_prompts"),
        F.coalesce(F.sum("n_user"), z).alias("user_messages"),
        F.coalesce(F.sum("n_assistant"), z).alias("assistant_messages"),
        F.count_if(F.col("n_user") > 1).alias("multi_turn_conversations"),
        chars.alias("total_characters"),
        # floor of the corpus total, not a sum of per-conversation floors
        F.expr(f"coalesce(sum(n_chars), 0) div {CHARS_PER_TOKEN}")
        .cast("bigint").alias("estimated_tokens"),
    ]


def corpus_stats(profile: DataFrame, by=None) -> DataFrame:
    """The eight corpus statistics over profile rows.

    ``profile`` needs n_messages, n_system, n_user, n_assistant, n_chars
    (from ``profile_conversations`` / ``profile_turns``); filter it to valid
    conversations first.  ``by`` optionally groups (e.g. by split).  An empty
    input gives one row of zeros.
    """
    if by:
        by = [by] if isinstance(by, str) else list(by)
        return profile.groupBy(*by).agg(*stat_exprs())
    return profile.agg(*stat_exprs())


def stats_report(stats: DataFrame) -> DataFrame:
    """Long display form: (position, stat, label, value, display).

    ``label`` is the snake-case name title-cased, ``display`` the value with
    thousands separators, as printed by the reference.
    """
    pairs = ", ".join(f"{i}, '{c}', {c}" for i, c in enumerate(STATS_COLUMNS))
    long = stats.selectExpr(
        f"stack({len(STATS_COLUMNS)}, {pairs}) as (position, stat, value)")
    return long.select(
        F.col("position").cast("bigint").alias("position"), "stat",
        pretty_key(F.col("stat")).alias("label"),
        F.col("value").cast("bigint").alias("value"),
        thousands(F.col("value")).alias("display"))


def file_audit(validated: DataFrame, by="file_name") -> DataFrame:
    """Per file: values decoded, lines that did not decode, and valid
    conversations kept (A9).  ``by`` may be a column name or Column."""
    decoded = F.col("reason").isNull() | (F.col("reason") != "parse_error")
    return (validated.groupBy(by)
            .agg(F.count_if(decoded).alias("raw_objects"),
                 F.count_if(~decoded).alias("parse_errors"),
                 F.count_if(F.col("reason").isNull()).alias("valid_conversations")))


def reject_counts(validated: DataFrame, by=("file_name",)) -> DataFrame:
    """Rejected values per group and reason (A10)."""
    return (validated.where(F.col("reason").isNotNull())
            .groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n")))


def split_sizes(split_df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split."""
    return split_df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
