"""Review table of sampled generations and the evaluation report.

review = first ``num_samples`` examples in dataset order (O3, before the
no-user skip) -> first-user context prompt (T6, T2) -> generation (X2) ->
expected answer (T7) -> display columns (F6-F8).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.functions.template import CHATML, ChatTemplate
from convforge.functions.text import or_default, preview
from convforge.operators.generate import batch_generate
from convforge.operators.render import eval_prompts
from convforge.schemas import REVIEW_PREVIEW_CHARS

def review_table(conv: DataFrame, order: str, generator_factory: Callable,
                 num_samples: int | None = None, template: ChatTemplate = CHATML,
                 params: dict | None = None, messages: str = "messages",
                 batch_size: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """(order, user_query, expected, generated, *_preview) rows.

    ``num_samples`` keeps the first examples by ``order`` (a TakeOrdered, no
    global sort); None reviews every example.
    """
    src = conv.select(order, messages)
    if num_samples is not None:
        src = src.orderBy(order).limit(int(num_samples))
    prompts = eval_prompts(src, [order], template, messages)
    # The carried columns ride through the Python worker: no self-join.
    gen = batch_generate(prompts, generator_factory, [order, "user_query", "expected"],
                         params=params, batch_size=batch_size, num_partitions=num_partitions)
    w = REVIEW_PREVIEW_CHARS
    return (gen
            .withColumn("user_preview", preview(F.col("user_query"), w, always_ellipsis=True))
            .withColumn("expected_preview",
                        preview(or_default(F.col("expected"), "N/A"), w, always_ellipsis=True))
            .withColumn("generated_preview", preview(F.col("generated"), w, always_ellipsis=True)))


def evaluation_report(ppl: DataFrame, n_val: int, review: DataFrame, order: str) -> DataFrame:
    """S6 as lines (pos, sub, value) of one JSON document: perplexity,
    num_val_samples (A14: the size of the split, scored or not) and
    sample_responses, one line per review row in ``order``, however many."""
    first = review.agg(F.min(order)).head()[0]
    def line(pos, value):
        value = F.lit(value) if isinstance(value, str) else value
        return F.struct(F.lit(pos).alias("pos"), value.alias("value"))

    shown = F.concat(F.lit('  "perplexity" : '), F.coalesce(F.col("perplexity").cast("string"), F.lit("null")),
                     F.lit(","))
    head = ppl.select(F.explode(F.array(
        line(0, "{"), line(1, shown), line(2, f'  "num_val_samples" : {int(n_val)},'),
        line(3, '  "sample_responses" : ['), line(5, "  ]"), line(6, "}"))).alias("x")).select(
        "x.pos", F.lit(0).cast("bigint").alias("sub"), "x.value")
    text = F.to_json(F.struct("user_query", "expected", "generated"), {"ignoreNullFields": "false"})
    comma = F.when(F.col(order) == F.lit(first), F.lit("    ")).otherwise(F.lit("   ,"))
    rows = review.select(F.lit(4).alias("pos"), F.col(order).cast("bigint").alias("sub"),
                         F.concat(comma, text).alias("value"))
    return head.unionByName(rows)
