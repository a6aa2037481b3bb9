"""Batch inference: a table of user queries -> prompts -> generated replies.

The single-query mode of the reference is the one-row case of the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from convforge.functions.template import CHATML, ChatTemplate
from convforge.operators import generate as gen
from convforge.operators import render as rd
from convforge.operators import replay as rp
from convforge.operators.conversations import to_nested
from convforge.schemas import DEFAULT_SYSTEM_PROMPT
from convforge.sources import processed as pr


def answer_queries(queries: DataFrame, generator_factory: Callable, keys=("query_id",),
                   query: str = "query", system_prompt: str | None = None,
                   default_system: str = DEFAULT_SYSTEM_PROMPT,
                   template: ChatTemplate = CHATML, params: dict | None = None,
                   batch_size: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """(keys..., query, prompt, generated) for every query row."""
    keys = list(keys)
    prompts = rd.build_prompts(queries.select(*keys, query), keys + [query], query,
                               system_prompt, default_system, template)
    return gen.batch_generate(prompts.select(*keys, query, "prompt"), generator_factory,
                              keys + [query, "prompt"], params=params, batch_size=batch_size,
                              num_partitions=num_partitions)


def answer_one(spark: SparkSession, text: str, generator_factory: Callable, **kw) -> str:
    """A single query; returns the reply string."""
    out = answer_queries(pr.query_table(spark, text), generator_factory, **kw)
    return out.first()["generated"]


def answer_sessions(log: DataFrame, generator_factory: Callable, session: str = "session",
                    line_no: str = "line_no", text: str = "text",
                    system_prompt: str = DEFAULT_SYSTEM_PROMPT, template: ChatTemplate = CHATML,
                    params: dict | None = None) -> DataFrame:
    """R2 -> conversations -> X2: replay logged sessions and generate the replies.

    (session, segment, messages): system prompt, then user messages and replies
    in turn; every reply sees the history before it.
    """
    rows = rp.replay_sessions(log, session, line_no, text, system_prompt)
    nested = to_nested(rows, [session, "segment"], order="position", text="content")
    return gen.chat_replies(nested, generator_factory, [session, "segment"], template, params)


def main(argv=None) -> int:
    """``python -m convforge.plans.inference --generator pkg.mod:factory --query '...'``

    Without ``--query``, answers every line of ``--queries_file`` and writes the
    answers as JSON lines to ``--output``.
    """
    import argparse

    from convforge.plans.cli import load_factory, session

    ap = argparse.ArgumentParser(description="Answer user queries with a generator")
    ap.add_argument("--generator", required=True, help="module:factory of the text generator")
    ap.add_argument("--query", default=None)
    ap.add_argument("--queries_file", default=None, help="text file, one query per line")
    ap.add_argument("--output", default=None)
    ap.add_argument("--system_prompt", default=None)
    a = ap.parse_args(argv)
    spark = session("convforge-inference")
    factory = load_factory(a.generator)
    if a.query:
        print(answer_one(spark, a.query, factory, system_prompt=a.system_prompt))
        return 0
    if not a.queries_file or not a.output:
        ap.error("give --query, or --queries_file with --output")
    from pyspark.sql import functions as F
    from convforge.functions.text import is_blank
    q = (spark.read.text(a.queries_file)
         .select(F.monotonically_increasing_id().alias("query_id"), F.col("value").alias("query"))
         .where(~is_blank(F.col("query"))))
    out = answer_queries(q, factory, system_prompt=a.system_prompt)
    out.select(F.to_json(F.struct("query", "generated")).alias("value")).write.mode("overwrite").text(a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
