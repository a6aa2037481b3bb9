"""Registered queries of this subpackage: one ``opN_<name>`` per operator.

Each applies its operator with production parameters to the whole table and
returns its full result.  ``ORACLE`` holds DuckDB SQL where SQL can state the
result; the other queries are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.llm import (decontam, fingerprints, hard_negatives, jaccard, langid, licenses, mixing, piece_codec,
                           quality, secrets, sharding, toxicity, whitening)
from convforge.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op1_quality")
def op1(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, quality.learnable(labels))
    return (quality.score(docs, model)
            .select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted"))


@register("op2_decontamination")
def op2(spark, sf_dir):
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op4_mixing")
def op4(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@register("op7_sharding")
def op7(spark, sf_dir):
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), n_shards=24)


@register("op5_langid")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.learnable(docs))
    return (langid.predict(docs, model)
            .select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score"))


@register("op6_secrets")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secrets.find(docs, secrets.fit(secrets.corpus_samples(docs)))


@register("op10_fingerprints")
def op10(spark, sf_dir):
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@register("op8_licenses")
def op8(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@register("op9_ngram_jaccard")
def op9(spark, sf_dir):
    return jaccard.ngram_jaccard_join(table(spark, sf_dir, "documents"), words=3, similarity=(90, 100))


@register("op11_sentencepiece")
def op11(spark, sf_dir):
    from public_tokenizers import path
    model = path("piece_bpe_32k.model")
    encoded = piece_codec.encode(table(spark, sf_dir, "documents"), model, keep=("doc_id",))
    return piece_codec.decode(encoded, model, keep=("doc_id", "ids")).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op12_hard_negatives")
def op12(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(
        table(spark, sf_dir, "embeddings").withColumn("label", label), anchors=F.col("id") % 100 == 0)


@register("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))
