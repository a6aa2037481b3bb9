"""Split files -> training text (the data half of the training script).

S4 read (declared schema) -> T1 render -> T3/T4 length budget -> text table.
Row-local after the scan; the dataset order key travels with each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.functions.template import CHATML, ChatTemplate
from convforge.operators import render as rd
from convforge.schemas import DEFAULT_MAX_TOKENS
from convforge.sources import processed as pr


def load_splits(spark: SparkSession, train_path: str, val_path: str | None = None):
    """(train, val-or-None) DataFrames of (file_name, line_index, messages)."""
    train = pr.read_processed(spark, train_path)
    if train is None:
        raise FileNotFoundError(train_path)
    val = pr.read_processed(spark, val_path) if val_path else None
    return train, val


def training_texts(split: DataFrame, template: ChatTemplate = CHATML,
                   max_tokens: int | None = DEFAULT_MAX_TOKENS, tokenizer_factory=None) -> DataFrame:
    """(file_name, line_index, text[, n_tokens, is_truncated, est_tokens]).

    ``max_tokens`` None keeps whole texts; with ``tokenizer_factory`` the
    budget is counted in real tokens (pandas UDF), else by the estimate.
    """
    texts = rd.chat_text(split, ["file_name", "line_index"], template)
    if max_tokens is None:
        return texts
    if tokenizer_factory is not None:
        return rd.truncate_exact(texts, tokenizer_factory, max_tokens=max_tokens)
    return rd.truncate_by_estimate(texts, max_tokens=max_tokens)


def write_training_texts(spark: SparkSession, train_path: str, out_path: str,
                         val_path: str | None = None, **kw) -> dict:
    """Render both splits to Parquet (``text`` plus order key); returns counts."""
    train, val = load_splits(spark, train_path, val_path)
    counts = {}
    for name, df in (("train", train), ("validation", val)):
        if df is None:
            continue
        training_texts(df, **kw).write.mode("overwrite").parquet(f"{out_path}/{name}")
        counts[name] = spark.read.parquet(f"{out_path}/{name}").count()
    return counts


def first_text_preview(texts: DataFrame, width: int = 500) -> DataFrame:
    """O5 for formatted text: the first example's first ``width`` characters."""
    return (texts.orderBy("file_name", "line_index").limit(1)
            .select(F.substring("text", 1, width).alias("preview")))


def main(argv=None) -> int:
    """``python -m convforge.plans.training_text --train data/train.jsonl --out texts``"""
    import argparse

    from convforge.plans.cli import load_factory, session

    ap = argparse.ArgumentParser(description="Render split files to training text")
    ap.add_argument("--train", default="data/train.jsonl")
    ap.add_argument("--val", default="data/val.jsonl")
    ap.add_argument("--out", required=True)
    ap.add_argument("--max_tokens", type=int, default=DEFAULT_MAX_TOKENS)
    ap.add_argument("--tokenizer", default=None,
                    help="module:factory of a tokenizer (encode, decode) for exact token budgets "
                         "(default: 3 characters a token)")
    a = ap.parse_args(argv)
    spark = session("convforge-training-text")
    factory = load_factory(a.tokenizer) if a.tokenizer else None
    counts = write_training_texts(spark, a.train, a.out, a.val, max_tokens=a.max_tokens,
                                  tokenizer_factory=factory)
    for k, v in counts.items():
        print(f"{k} samples: {v}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
