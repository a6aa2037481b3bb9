"""Scoring and perplexity.

A scorer turns each rendered example into ``(loss, n_tokens)``: mean
per-token negative log-likelihood and the number of (truncated) tokens.
Perplexity is ``exp(sum(loss * n) / sum(n))``, an ordinary partial + final
aggregate.  The running value in dataset order uses the two-level prefix
sum of ``operators.ordering``.

Two scorers are provided:

* ``score_with`` runs a user-supplied model in ``mapInPandas``; the factory
  builds the model once per task on the executor.
* ``UnigramScorer`` is a built-in stand-in (add-one smoothed unigram counts
  of the training texts) so the whole evaluation runs without a GPU model;
  it is pure DataFrame work: explode, aggregate, skew-aware lookup join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convforge.operators.joins import skew_aware_lookup
from convforge.operators.ordering import ranked_running
from convforge.schemas import DEFAULT_MAX_TOKENS, RUNNING_EVERY
from convforge.session import materialize

# Word pattern of the stand-in tokenizer: runs of letters, marks and digits.
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]+"


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0)


class UnigramScorer:
    """Add-one smoothed unigram model fitted on training texts.

    p(w) = (count(w) + 1) / (N + V + 1), N = training tokens, V = distinct
    training tokens; unseen words get count 0.
    """

    def __init__(self, counts: DataFrame, n_tokens: int, vocab: int,
                 max_tokens: int = DEFAULT_MAX_TOKENS):
        self.counts = counts
        self.n_tokens = int(n_tokens)
        self.vocab = int(vocab)
        self.max_tokens = int(max_tokens)

    @classmethod
    def fit(cls, texts: DataFrame, text: str = "text",
            max_tokens: int = DEFAULT_MAX_TOKENS) -> "UnigramScorer":
        counts = (texts.select(F.explode(word_tokens(F.col(text))).alias("tok"))
                  .groupBy("tok").agg(F.count(F.lit(1)).alias("cnt")))
        # The fitted model is a table: written once to the shared checkpoint
        # folder, then read by the totals below and by every scoring join.
        counts = materialize(counts)
        # Two scalars come back to the driver; the vocabulary stays distributed.
        tot = counts.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"),
                         F.count(F.lit(1)).alias("v")).first()
        return cls(counts, tot["n"], tot["v"], max_tokens)

    def score(self, texts: DataFrame, keys, text: str = "text") -> DataFrame:
        """(keys..., loss, n_tokens) for every row of ``texts``.

        Only the first ``max_tokens`` words count (truncation).  Rows without
        any word get n_tokens 0 and a NULL loss.
        """
        keys = list(keys)
        toks = (texts.select(*keys, F.posexplode_outer(word_tokens(F.col(text))).alias("pos", "tok"))
                .where(F.col("pos").isNull() | (F.col("pos") < self.max_tokens)))
        # Pre-aggregate to one row per (example, word) before the lookup.
        per = toks.groupBy(*keys, "tok").agg(F.count("tok").alias("c"))
        looked = skew_aware_lookup(per, self.counts, "tok", "cnt", self.n_tokens, how="left")
        denom = float(self.n_tokens + self.vocab + 1)
        nll = -F.log((F.coalesce(F.col("cnt"), F.lit(0)) + F.lit(1)) / F.lit(denom))
        agg = looked.groupBy(*keys).agg(
            F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_tokens"),
            F.sum(F.when(F.col("tok").isNotNull(), F.col("c") * nll)).alias("_nll"))
        return agg.select(*keys, (F.col("_nll") / F.nullif(F.col("n_tokens"), F.lit(0)))
                          .alias("loss"), "n_tokens")


def score_with(texts: DataFrame, scorer_factory: Callable, keys, text: str = "text",
               batch_size: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Score with a user model (X3): ``scorer_factory()`` returns a callable
    mapping a list of texts to a list of ``(loss, n_tokens)`` pairs.

    Runs in ``mapInPandas``: Arrow batches in, one model per task;
    ``batch_size`` caps the texts per model call, ``num_partitions`` spreads
    the rows over that many tasks first.
    """
    from convforge.operators.generate import micro_batches
    import pandas as pd

    keys = list(keys)
    fields = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + ", loss double, n_tokens bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = scorer_factory()
        for pdf in batches:
            res = [r for chunk in micro_batches(pdf[text].tolist(), batch_size)
                   for r in model(chunk)]
            out = pdf[keys].copy()
            out["loss"] = [float(r[0]) if r[0] is not None else None for r in res]
            out["n_tokens"] = [int(r[1]) for r in res]
            yield out

    src = texts.select(*keys, text)
    if num_partitions:
        src = src.repartition(int(num_partitions))
    return src.mapInPandas(run, schema)


def perplexity(scores: DataFrame, loss: str = "loss", n: str = "n_tokens") -> DataFrame:
    """One row: perplexity, total_tokens, num_samples.

    NULL perplexity when there are no tokens (the reference divides by zero).
    """
    w = F.col(loss) * F.col(n)
    tot_n = F.coalesce(F.sum(F.when(F.col(loss).isNotNull(), F.col(n))), F.lit(0))
    return scores.agg(
        F.exp(F.sum(w) / F.nullif(tot_n, F.lit(0))).alias("perplexity"),
        tot_n.cast("bigint").alias("total_tokens"),
        F.count(F.lit(1)).alias("num_samples"))


def running_perplexity(scores: DataFrame, order: str, bucket: Column,
                       loss: str = "loss", n: str = "n_tokens",
                       every: int = RUNNING_EVERY, n_buckets: int = 1 << 16,
                       materialize_input: bool = False) -> DataFrame:
    """(processed, running_perplexity) after every ``every``-th example.

    ``order`` is the dataset order (e.g. ``split_rank``) and ``bucket`` an
    order-preserving coarsening of it with balanced buckets.
    """
    s = (scores.withColumn("_ln", F.coalesce(F.col(loss) * F.col(n), F.lit(0.0)))
         .withColumn("_n", F.when(F.col(loss).isNotNull(), F.col(n)).otherwise(F.lit(0))))
    r = ranked_running(s, bucket, order, sums=["_ln", "_n"], rank_col="processed",
                       n_buckets=n_buckets, materialize_input=materialize_input)
    return (r.where(F.col("processed") % every == 0)
            .select("processed",
                    F.exp(F.col("run__ln") / F.nullif(F.col("run__n"), F.lit(0)))
                    .alias("running_perplexity")))
