"""Corpus pipeline: quality, near duplicates, decontamination, mixing, shards.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.
"""

from __future__ import annotations

import functools
import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.llm import decontam, jaccard, mixing, quality, sharding
from convforge.llm.common import attach_small, discard, recording, row_key, table, written

_left: list[DataFrame] = []


def stage(fn):
    """A stage, which first removes what the one before left in the checkpoint folder:
    by then that one's result is written, and nothing else reads its intermediates.
    Collecting garbage lets Spark's cleaner remove its shuffle files too."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(*_left)
        _left.clear()
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        with recording(_left):
            return fn(spark, docs, sf_dir)
    return run


@stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    columns = docs.columns
    return quality.score(docs, model, keep=tuple(columns)).where("predicted = 1").select(*columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id (null last);
    five-word shingles, Jaccard similarity 0.8 or more.  Decisions are by row: texts
    that share an id stand for themselves, rows equal in id and text are one.  Rows
    without words belong to no group and stay."""
    keyed = docs.withColumn("_row", row_key("doc_id", "text"))
    groups = jaccard.ngram_jaccard_join(keyed, id_col="_row", words=5, similarity=(80, 100))
    groups = written(groups.where("n_shingles > 0"), "groups")
    gone = written(groups.where("_row <> component_id").select("_row").distinct(), "duplicates")
    left = attach_small(keyed, gone, "_row", "left_anti")
    twice = written(groups.where("_row = component_id").groupBy("_row").count()
                    .where("count > 1").select("_row"), "repeated")
    if twice.isEmpty():
        return left.select(*docs.columns)
    once = attach_small(left, twice, "_row", "left_semi").dropDuplicates(["_row"])
    return attach_small(left, twice, "_row", "left_anti").unionByName(once).select(*docs.columns)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; decisions are by row."""
    keyed = docs.withColumn("_row", row_key("doc_id", "text"))
    found = decontam.find_contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="_row")
    gone = written(found.select("_row").distinct(), "contaminated")
    return attach_small(keyed, gone, "_row", "left_anti").select(*docs.columns)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them."""
    names = tuple(docs.columns)
    keep = tuple(f"_doc_{i}" for i in range(len(names)))
    mixed = mixing.mix_sources(docs.select("*", *[F.col(c).alias(k) for c, k in zip(names, keep)]),
                               keep=keep)
    return (mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
                 .select(*[F.col(k).alias(c) for c, k in zip(names, keep)]))


@stage
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    rest = tuple(c for c in docs.columns if c != "doc_id")
    return sharding.shard_by_bytes(docs, n_shards=24, keep=rest)


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Trained scores, fuzzy joins and iterative solutions are beyond SQL; the
#: stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, fn in STAGES:
        docs = written(fn(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
