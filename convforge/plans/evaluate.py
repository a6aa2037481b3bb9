"""Evaluation job: perplexity over the validation split and a review report.

    S4 val -> order key -> T1 render -> scorer (user model or unigram
    stand-in) -> A12 perplexity + W1 running values (every 10th example)
    S4 val -> O3 first k -> T6/T2 prompts -> X2 generation -> T7 -> review
    -> S6 report (perplexity, num_val_samples, sample_responses)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.functions.template import CHATML, ChatTemplate
from convforge.functions.text import timestamp_suffix, two_decimals
from convforge.operators.ordering import running_within
from convforge.operators import render as rd
from convforge.operators import review as rv
from convforge.operators import score as sc
from convforge.operators.joins import attach_results
from convforge.schemas import DEFAULT_MAX_TOKENS, DEFAULT_NUM_SAMPLES, RUNNING_EVERY
from convforge.session import materialize
from convforge.sources import processed as pr


def with_dataset_order(split: DataFrame, order: str = "example") -> DataFrame:
    """Add a 1-based dataset position from (part file, line) order."""
    return pr.dataset_order(split, order)


def evaluate(spark: SparkSession, val_path: str, generator_factory: Callable,
             scorer_factory: Callable | None = None, train_path: str | None = None,
             num_samples: int | None = DEFAULT_NUM_SAMPLES, max_samples: int | None = None,
             template: ChatTemplate = CHATML, max_tokens: int = DEFAULT_MAX_TOKENS,
             output: str | None = None, output_dir: str = "outputs",
             tokenizer_factory: Callable | None = None, batch_size: int | None = None,
             num_partitions: int | None = None, scores_table: DataFrame | None = None,
             running_every: int = RUNNING_EVERY) -> dict:
    """Run the evaluation; returns perplexity, sample count and report path.

    ``scorer_factory`` scores with a user model; without it the unigram
    stand-in is fitted on ``train_path``.  ``max_samples`` limits perplexity
    to the first examples (O2), ``num_samples`` the review (O3);
    ``running_every`` spaces the rows of the running perplexity.
    ``batch_size`` / ``num_partitions`` size the model calls (see
    ``generate.batch_generate``).  ``scores_table`` takes scores produced
    elsewhere -- (file_name, line_index, loss, n_tokens) of the validation
    files -- instead of scoring here (J3).  A user model's texts are cut to
    ``max_tokens`` real tokens with ``tokenizer_factory``, else by the
    3-characters-a-token estimate; the stand-in scorer counts its own words
    and cuts at ``max_tokens`` of them.
    """
    val = pr.read_processed(spark, val_path)
    if val is None:
        raise FileNotFoundError(f"{val_path} not found; run the preparation first")
    val = with_dataset_order(val)
    scored_src = val if max_samples is None else val.where(F.col("example") <= max_samples)
    rendered = rd.chat_text(scored_src, ["example"], template)
    if scores_table is not None:
        keyed = scored_src.select("example", "file_name", "line_index")
        scores = attach_results(keyed, scores_table, ["file_name", "line_index"]).select(
            "example", F.col("loss").cast("double").alias("loss"),
            F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(0)).alias("n_tokens"))
    elif scorer_factory is not None:
        texts = (rd.truncate_exact(rendered, tokenizer_factory, max_tokens=max_tokens)
                 if tokenizer_factory is not None
                 else rd.truncate_by_estimate(rendered, max_tokens=max_tokens))
        scores = sc.score_with(texts, scorer_factory, ["example"], batch_size=batch_size,
                               num_partitions=num_partitions)
    else:
        if train_path is None:
            raise ValueError("the stand-in scorer needs train_path")
        train = pr.read_processed(spark, train_path)
        scorer = sc.UnigramScorer.fit(rd.chat_text(train, ["line_index"], template),
                                      max_tokens=max_tokens)
        scores = scorer.score(rendered, ["example"])
    # Scores feed the overall and the running value: computed once.
    scores = materialize(scores)
    ppl = sc.perplexity(scores)
    run = running(scores, every=running_every).withColumn("running_display", two_decimals("running_perplexity"))
    # Generated once: the report reads it twice.
    review = materialize(rv.review_table(val, "example", generator_factory, num_samples, template,
                                         batch_size=batch_size, num_partitions=num_partitions))
    n_val = val.count()
    report = rv.evaluation_report(ppl, n_val, review, "example")
    if output is None:
        stamp = spark.range(1).select(timestamp_suffix()).first()[0]
        output = f"{output_dir}/eval_results_{stamp}.json"
    pr.write_report(report, output)
    run.write.mode("overwrite").parquet(f"{output}_running")
    return {"perplexity": ppl.first()["perplexity"], "num_val_samples": n_val,
            "report_path": output, "running_path": f"{output}_running"}


def running(scores: DataFrame, order: str = "example", every: int = RUNNING_EVERY) -> DataFrame:
    """W1 on scores keyed by a contiguous 1-based dataset position, of any length: blocks
    of 10,000 examples are summed up in three levels."""
    bucket = F.expr(f"({order} - 1) div 10000")
    s = (scores.withColumn("_ln", F.coalesce(F.col("loss") * F.col("n_tokens"), F.lit(0.0)))
         .withColumn("_n", F.when(F.col("loss").isNotNull(), F.col("n_tokens")).otherwise(F.lit(0))))
    r = running_within(s, [], order, bucket, ["_ln", "_n"], levels=3)
    return (r.where(F.col(order) % every == 0)
            .select(F.col(order).cast("bigint").alias("processed"),
                    F.exp(F.col("run__ln") / F.nullif(F.col("run__n"), F.lit(0))).alias("running_perplexity")))


def main(argv=None) -> int:
    """``python -m convforge.plans.evaluate --generator pkg.mod:factory ...``"""
    import argparse

    from convforge.plans.cli import load_factory, session

    ap = argparse.ArgumentParser(description="Perplexity and sample review on the validation split")
    ap.add_argument("--val_path", default="data/val.jsonl")
    ap.add_argument("--train_path", default="data/train.jsonl",
                    help="fits the stand-in scorer when no --scorer is given")
    ap.add_argument("--generator", required=True, help="module:factory of the text generator")
    ap.add_argument("--scorer", default=None, help="module:factory of the scorer")
    ap.add_argument("--num_samples", type=int, default=DEFAULT_NUM_SAMPLES)
    ap.add_argument("--max_tokens", type=int, default=DEFAULT_MAX_TOKENS)
    ap.add_argument("--output", default=None)
    ap.add_argument("--tokenizer", default=None,
                    help="module:factory of a tokenizer (encode, decode) for exact truncation")
    ap.add_argument("--batch_size", type=int, default=None, help="examples per model call")
    ap.add_argument("--num_partitions", type=int, default=None, help="tasks for model calls")
    ap.add_argument("--scores_table", default=None,
                    help="Parquet of (file_name, line_index, loss, n_tokens) scored elsewhere")
    a = ap.parse_args(argv)
    spark = session("convforge-evaluate")
    scores = spark.read.parquet(a.scores_table) if a.scores_table else None
    r = evaluate(spark, a.val_path, load_factory(a.generator), load_factory(a.scorer),
                 train_path=a.train_path, num_samples=a.num_samples, max_tokens=a.max_tokens,
                 output=a.output,
                 tokenizer_factory=load_factory(a.tokenizer) if a.tokenizer else None,
                 batch_size=a.batch_size, num_partitions=a.num_partitions, scores_table=scores)
    ppl = r["perplexity"]
    shown = "n/a" if ppl is None else f"{ppl:.2f}"
    print(f"{r['num_val_samples']} validation examples, perplexity {shown}")
    print(f"report: {r['report_path']}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
