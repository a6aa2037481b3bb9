"""Rendering conversations to training / prompt text.

Everything is a built-in expression over the nested message array; no
shuffle.  Per-conversation extraction on the long table (first user query,
expected answer) uses algebraic aggregates instead of the array.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convforge.functions.template import CHATML, ChatTemplate
from convforge.functions.text import or_default
from convforge.schemas import CHARS_PER_TOKEN, DEFAULT_MAX_TOKENS, DEFAULT_SYSTEM_PROMPT


def chat_text(conv: DataFrame, keys, template: ChatTemplate = CHATML,
              add_generation_prompt: bool = False, messages: str = "messages") -> DataFrame:
    """(keys..., text): each conversation rendered by the template.

    Like ``remove_columns`` in the reference, only the keys and ``text``
    remain.
    """
    return conv.select(*keys, template.render(F.col(messages), add_generation_prompt).alias("text"))


def estimate_tokens(text: Column) -> Column:
    """Token estimate of a text: code points div 3 (T4, default mode)."""
    return F.floor(F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def truncate_by_estimate(df: DataFrame, text: str = "text",
                         max_tokens: int = DEFAULT_MAX_TOKENS) -> DataFrame:
    """Keep at most ``max_tokens`` estimated tokens of ``text``.

    Adds ``n_tokens`` (estimate of the kept text), ``is_truncated`` and
    replaces ``text`` by its first ``max_tokens * 3`` code points.  The
    estimate of the whole text is ``est_tokens``.
    """
    budget = int(max_tokens) * CHARS_PER_TOKEN
    t = F.col(text)
    return (df.withColumn("est_tokens", estimate_tokens(t))
              .withColumn("is_truncated", F.length(t) > budget)
              .withColumn(text, F.substring(t, 1, budget))
              .withColumn("n_tokens", estimate_tokens(F.col(text))))


def truncate_exact(df: DataFrame, tokenizer_factory, text: str = "text",
                   max_tokens: int = DEFAULT_MAX_TOKENS) -> DataFrame:
    """Exact-mode T3/T4 with a user tokenizer (``encode``/``decode``).

    ``tokenizer_factory()`` runs once per Arrow batch stream on the executor;
    the tokenizer object is never shipped from the driver.
    """
    limit = int(max_tokens)

    # Iterator form: one tokenizer per task rather than per batch.
    @F.pandas_udf("struct<text string, n_tokens bigint, is_truncated boolean>")
    def _cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tok = tokenizer_factory()
        for s in batches:
            out_text, out_n, out_cut = [], [], []
            for v in s:
                if v is None:
                    out_text.append(None)
                    out_n.append(0)
                    out_cut.append(False)
                    continue
                ids = tok.encode(v)
                keep = ids[:limit]
                out_text.append(tok.decode(keep) if len(ids) > limit else v)
                out_n.append(len(keep))
                out_cut.append(len(ids) > limit)
            yield pd.DataFrame({"text": out_text, "n_tokens": out_n, "is_truncated": out_cut})

    r = _cut(F.col(text))
    return (df.withColumn("_cut", r)
              .withColumn(text, F.col("_cut.text"))
              .withColumn("n_tokens", F.col("_cut.n_tokens"))
              .withColumn("is_truncated", F.col("_cut.is_truncated"))
              .drop("_cut"))


def prompt_messages(query: Column, system: Column | str | None = None,
                    default_system: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """[system, user] message array for a single query."""
    sys_col = F.lit(system) if isinstance(system, str) or system is None else system
    sys_text = or_default(sys_col.cast("string"), default_system)
    return F.array(
        F.struct(F.lit("system").alias("role"), sys_text.alias("content")),
        F.struct(F.lit("user").alias("role"), query.alias("content")))


def build_prompts(queries: DataFrame, keys, query: str = "query",
                  system: Column | str | None = None,
                  default_system: str = DEFAULT_SYSTEM_PROMPT,
                  template: ChatTemplate = CHATML) -> DataFrame:
    """(keys..., messages, prompt) for a table of queries (T5 + T2)."""
    msgs = prompt_messages(F.col(query), system, default_system)
    return (queries.select(*keys, msgs.alias("messages"))
            .withColumn("prompt", template.render(F.col("messages"), add_generation_prompt=True)))


def first_user_context(messages: Column) -> Column:
    """Messages up to and including the first user message.

    NULL when there is no user message, so such rows drop out (P15).
    """
    pos = F.array_position(F.transform(messages, lambda m: m["role"]), "user")
    return F.when(pos > 0, F.slice(messages, F.lit(1), pos.cast("int")))


def first_content(messages: Column, role: str) -> Column:
    """Content of the first message with ``role`` anywhere."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(1))["content"]


def eval_prompts(conv: DataFrame, keys, template: ChatTemplate = CHATML,
                 messages: str = "messages") -> DataFrame:
    """(keys..., user_query, expected, prompt) for evaluation generation.

    ``prompt`` renders the first-user context with the generation prompt;
    conversations without a (non-empty) user message are skipped (P15).
    """
    m = F.col(messages)
    ctx = first_user_context(m)
    return (conv.select(*keys,
                        first_content(m, "user").alias("user_query"),
                        first_content(m, "assistant").alias("expected"),
                        ctx.alias("_ctx"))
            .where(F.col("user_query").isNotNull() & (F.col("user_query") != ""))
            .withColumn("prompt", template.render(F.col("_ctx"), add_generation_prompt=True))
            .drop("_ctx"))


def first_user_expected_long(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                             role: str = "role", text: str = "text",
                             valid_only: bool = False) -> DataFrame:
    """Long-table form of T6/T7 extraction with algebraic aggregates.

    (key, user_turn, user_query, expected): the first user message, its turn,
    and the first assistant message anywhere, contents stripped.  ``min`` of
    a (turn, content) struct combines map-side, so a huge conversation is not
    gathered.  ``valid_only`` evaluates the validation rules in the same
    grouping and keeps valid conversations only (one scan, no join).
    """
    from convforge.functions.text import py_strip
    from convforge.operators.validate import profile_aggregates, profile_outcome

    def first(r):
        return F.min(F.when(F.col(role) == r, F.struct(F.col(order).alias("t"),
                                                        py_strip(F.col(text)).alias("c"))))
    aggs = [first("user").alias("_u"), first("assistant").alias("_a")]
    if valid_only:
        aggs += profile_aggregates(order, role, text)
    agg = turns.groupBy(key).agg(*aggs)
    if valid_only:
        agg = profile_outcome(agg).where(F.col("reason").isNull())
    return (agg.select(key, F.col("_u.t").alias("user_turn"), F.col("_u.c").alias("user_query"),
                       F.col("_a.c").alias("expected"))
            .where(F.col("user_query").isNotNull() & (F.col("user_query") != "")))
