"""Batch generation over a table of prompts.

The reference answers one prompt at a time on one GPU.  Here prompts are a
DataFrame; ``mapInPandas`` hands Arrow batches to a user generator that is
built once per task by ``generator_factory()`` on the executor (the model is
never pickled from the driver).  The generator returns only the new text
for each prompt; it is stripped as the reference strips decoded output.
Generation parameters are passed through unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from convforge.functions.template import CHATML, ChatTemplate
from convforge.schemas import DEFAULT_GENERATION


def micro_batches(items: list, size: int | None):
    """Consecutive slices of at most ``size`` items (all at once if None)."""
    if not size:
        yield items
        return
    for i in range(0, len(items), size):
        yield items[i:i + size]


def batch_generate(prompts: DataFrame, generator_factory: Callable, keys,
                   prompt: str = "prompt", out: str = "generated",
                   params: dict | None = None, batch_size: int | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """(keys..., generated) for every prompt row.

    ``keys`` are carried through unchanged (any columns, not only ids).

    ``generator_factory()`` must return a callable
    ``gen(list_of_prompts, **params) -> list_of_strings``.  ``batch_size``
    caps how many prompts one call receives (device memory);
    ``num_partitions`` spreads the prompt rows round-robin over that many
    tasks first (e.g. one per accelerator).
    """
    import pandas as pd

    keys = list(keys)
    gen_params = dict(DEFAULT_GENERATION)
    gen_params.update(params or {})
    fields = {f.name: f.dataType.simpleString() for f in prompts.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + f", `{out}` string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = generator_factory()
        for pdf in batches:
            texts = [t for chunk in micro_batches(pdf[prompt].tolist(), batch_size)
                     for t in gen(chunk, **gen_params)]
            res = pdf[keys].copy()
            res[out] = [t.strip() if t is not None else None for t in texts]
            yield res

    cols = keys + ([prompt] if prompt not in keys else [])
    src = prompts.select(*cols)
    if num_partitions:
        src = src.repartition(int(num_partitions))
    return src.mapInPandas(run, schema)


def chat_replies(conv: DataFrame, generator_factory: Callable, keys, template: ChatTemplate = CHATML,
                 params: dict | None = None, messages: str = "messages") -> DataFrame:
    """(keys..., messages) with a reply after every user message.

    ``messages`` holds a conversation's system prompt and user messages, as replay
    gives them.  Each reply is generated from the whole history so far, replies
    included; the conversations of an Arrow batch take their turns together.
    """
    import pandas as pd

    keys = list(keys)
    gen_params = dict(DEFAULT_GENERATION)
    gen_params.update(params or {})
    src = conv.select(*keys, messages)
    before, after = template.message_prefix.split("{role}", 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = generator_factory()
        for pdf in batches:
            todo = [list(m) for m in pdf[messages]]
            done: list[list] = [[] for _ in todo]
            while any(todo):
                asked = []
                for i, left in enumerate(todo):
                    while left:
                        m = left.pop(0)
                        done[i].append({"role": m["role"], "content": m["content"]})
                        if m["role"] == "user":
                            asked.append(i)
                            break
                prompts = ["".join(before + m["role"] + after + m["content"] + template.message_suffix
                                   for m in done[i]) + template.generation_prompt for i in asked]
                for i, reply in zip(asked, gen(prompts, **gen_params) if prompts else []):
                    done[i].append({"role": "assistant", "content": reply.strip()})
            yield pdf[keys].assign(**{messages: done})

    return src.mapInPandas(run, src.schema)


class EchoGenerator:
    """Deterministic stand-in model: replies with the length and the digest of the
    whole prompt, so that any damage to it shows.  Useful for tests and dry runs
    of the evaluation plan."""

    def __call__(self, prompts, **params):
        return [f" reply:{len(p)} {hashlib.md5(p.encode()).hexdigest()}\n" for p in prompts]
