"""Registered queries over the test tables, each with a DuckDB oracle.

Every query reads whole tables (or data Spark derives from them) and
returns a DataFrame; ``ORACLE[name]`` is the same result written in DuckDB
SQL over the same Parquet files.  Column names and types agree so results
can be compared value by value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convforge.functions.template import CHATML
from convforge.functions.text import is_blank, preview, py_strip, timestamp_suffix
from convforge.functions.tokenizer import RankTokenizer
from convforge.operators import conversations as conv
from convforge.operators import generate as gen
from convforge.operators import render as rd
from convforge.operators import replay as rp
from convforge.operators import review as rv
from convforge.operators import score as sc
from convforge.operators.ordering import md5_bucket, running_within
from convforge.operators import split as splitting
from convforge.operators import stats as st
from convforge.operators import validate as va
from convforge.plans import evaluate as ev
from convforge.plans import inference as inf
from convforge.plans import injected as inj
from convforge.plans import oracle as oq
from convforge.plans import prepare as prep
from convforge.plans import training_text as tt
from convforge.sources import curated as cur
from convforge.sources import processed as pr
from convforge.streaming import ingest as stream
from convforge.session import apply_core_conf, scratch_path, write_through

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_core_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Shared derivations
# ---------------------------------------------------------------------------
def conv_profile(spark, sf_dir) -> DataFrame:
    """Per-conversation sizes and validation outcome of the long table."""
    return va.profile_turns(table(spark, sf_dir, "conversations"))


def valid_profile(spark, sf_dir) -> DataFrame:
    return conv_profile(spark, sf_dir).where(F.col("reason").isNull())


def conv_split(spark, sf_dir, val_ratio=0.1, seed=42) -> DataFrame:
    """Valid conversations with their split labels and ranks."""
    # The profile (one row per conversation) is written once and ranked from there.
    return splitting.assign_split(valid_profile(spark, sf_dir), "conv_id",
                                  val_ratio=val_ratio, seed=seed, materialize_input=True)


# ---------------------------------------------------------------------------
# Validation and statistics
# ---------------------------------------------------------------------------
@register("conv_valid", f"""
WITH {oq.PROFILE_CTE}
SELECT conv_id, n_messages, n_system, n_user, n_assistant, n_chars,
       coalesce(reason, 'ok') AS outcome,
       CAST(coalesce(CASE WHEN reason = first_r THEN first_turn END, -1) AS BIGINT) AS bad_turn
FROM prof""")
def q_conv_valid(spark, sf_dir):
    p = conv_profile(spark, sf_dir)
    return p.select("conv_id", "n_messages", "n_system", "n_user", "n_assistant", "n_chars",
                    F.coalesce("reason", F.lit("ok")).alias("outcome"),
                    F.coalesce("bad_turn", F.lit(-1)).cast("bigint").alias("bad_turn"))


@register("corpus_stats", f"""
WITH {oq.PROFILE_CTE}
SELECT {oq.STATS_SELECT} FROM valid""")
def q_corpus_stats(spark, sf_dir):
    return st.corpus_stats(valid_profile(spark, sf_dir))


@register("stats_report", f"""
WITH {oq.PROFILE_CTE},
s AS (SELECT {oq.STATS_SELECT} FROM valid),
l AS (
  UNPIVOT s ON conversations, total_turns, system_prompts, user_messages, assistant_messages,
             multi_turn_conversations, total_characters, estimated_tokens
  INTO NAME stat VALUE value)
SELECT CAST(list_position(['conversations', 'total_turns', 'system_prompts', 'user_messages',
                           'assistant_messages', 'multi_turn_conversations', 'total_characters',
                           'estimated_tokens'], stat) - 1 AS BIGINT) AS position,
       stat,
       list_aggregate(list_transform(string_split(stat, '_'),
                      lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS label,
       CAST(value AS BIGINT) AS value,
       format('{{:,}}', value) AS display
FROM l""")
def q_stats_report(spark, sf_dir):
    return st.stats_report(st.corpus_stats(valid_profile(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Split
# ---------------------------------------------------------------------------
@register("train_val_split", f"""
WITH {oq.PROFILE_CTE}, {oq.split_cte()}
SELECT conv_id, split, shuffle_rank, split_rank FROM labelled""")
def q_train_val_split(spark, sf_dir):
    return conv_split(spark, sf_dir).select("conv_id", "split", "shuffle_rank", "split_rank")


@register("split_sizes", f"""
WITH {oq.PROFILE_CTE}, {oq.split_cte()}
SELECT split, CAST(count(*) AS BIGINT) AS n FROM labelled GROUP BY split""")
def q_split_sizes(spark, sf_dir):
    return st.split_sizes(conv_split(spark, sf_dir))


@register("split_stats", f"""
WITH {oq.PROFILE_CTE}, {oq.split_cte()}
SELECT split, {oq.STATS_SELECT} FROM labelled GROUP BY split""")
def q_split_stats(spark, sf_dir):
    return st.corpus_stats(conv_split(spark, sf_dir), by="split")


# ---------------------------------------------------------------------------
# Rendering
# ---------------------------------------------------------------------------
def valid_nested(spark, sf_dir) -> DataFrame:
    """Valid conversations of the long table as (conv_id, messages)."""
    nested = conv.to_nested(table(spark, sf_dir, "conversations"))
    return va.accepted(va.validate_typed(nested), ["conv_id"])


def nested_split(spark, sf_dir, split: str | None = None, val_ratio=0.1, seed=42,
                 labels: DataFrame | None = None) -> DataFrame:
    """(conv_id, split, split_rank, messages) of valid conversations, of one split or
    both.  The split is ranked on the narrow profile (or given as ``labels``); only the
    turns of the wanted conversations are then nested (the join and the grouping share
    one shuffle on conv_id)."""
    keys = ["conv_id", "split", "split_rank"]
    if labels is None:
        labels = conv_split(spark, sf_dir, val_ratio, seed).select(*keys)
    if split is not None:
        labels = labels.where(F.col("split") == split)
    turns = (table(spark, sf_dir, "conversations").join(labels, "conv_id")
             .select(*keys, "turn", "role", py_strip(F.col("text")).alias("text")))
    return conv.to_nested(turns, keys)


@register("chat_text", f"""
WITH {oq.VALID_MSGS_CTE}
SELECT conv_id, string_agg({oq.chatml('role', 'content')}, '' ORDER BY turn) AS text
FROM vm GROUP BY conv_id""")
def q_chat_text(spark, sf_dir):
    return rd.chat_text(valid_nested(spark, sf_dir), ["conv_id"])


@register("chat_prompt", f"""
WITH {oq.VALID_MSGS_CTE}
SELECT conv_id, string_agg({oq.chatml('role', 'content')}, '' ORDER BY turn) || {oq.GEN_PROMPT} AS prompt
FROM vm GROUP BY conv_id""")
def q_chat_prompt(spark, sf_dir):
    return (rd.chat_text(valid_nested(spark, sf_dir), ["conv_id"], add_generation_prompt=True)
            .withColumnRenamed("text", "prompt"))


@register("train_text", f"""
WITH {oq.VALID_MSGS_CTE}, {oq.split_cte()},
t AS (SELECT conv_id, string_agg({oq.chatml('role', 'content')}, '' ORDER BY turn) AS full_text
      FROM vm GROUP BY conv_id)
SELECT l.conv_id, l.split, l.split_rank,
       substring(t.full_text, 1, 6144) AS text,
       CAST(length(t.full_text) // 3 AS BIGINT) AS est_tokens,
       length(t.full_text) > 6144 AS is_truncated,
       CAST(length(substring(t.full_text, 1, 6144)) // 3 AS BIGINT) AS n_tokens
FROM labelled l JOIN t USING (conv_id)""")
def q_train_text(spark, sf_dir):
    s = nested_split(spark, sf_dir)
    texts = rd.chat_text(s, ["conv_id", "split", "split_rank"])
    return rd.truncate_by_estimate(texts).select(
        "conv_id", "split", "split_rank", "text", "est_tokens", "is_truncated", "n_tokens")


@register("truncate_text", """
SELECT doc_id, CAST(length(text) // 3 AS BIGINT) AS est_tokens,
       length(text) > 6144 AS is_truncated,
       substring(text, 1, 6144) AS text,
       CAST(length(substring(text, 1, 6144)) // 3 AS BIGINT) AS n_tokens
FROM documents""")
def q_truncate_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rd.truncate_by_estimate(docs).select("doc_id", "est_tokens", "is_truncated", "text", "n_tokens")


@register("query_prompts", f"""
SELECT conv_id, turn,
       {oq.chatml("'system'", "'You are a helpful assistant.'")} ||
       {oq.chatml("'user'", oq.strip('text'))} || {oq.GEN_PROMPT} AS prompt
FROM conversations
WHERE role = 'user' AND length({oq.strip('text')}) > 0""")
def q_query_prompts(spark, sf_dir):
    users = (table(spark, sf_dir, "conversations")
             .where((F.col("role") == "user") & ~is_blank(F.col("text")))
             .select("conv_id", "turn", py_strip(F.col("text")).alias("query")))
    return rd.build_prompts(users, ["conv_id", "turn"]).select("conv_id", "turn", "prompt")


@register("eval_context", f"""
WITH {oq.VALID_MSGS_CTE}, {oq.split_cte()},
fu AS (SELECT conv_id, min(turn) AS ut FROM vm WHERE role = 'user' GROUP BY conv_id)
SELECT vm.conv_id,
       string_agg({oq.chatml('vm.role', 'vm.content')}, '' ORDER BY vm.turn) || {oq.GEN_PROMPT} AS prompt
FROM vm JOIN fu USING (conv_id) JOIN labelled l USING (conv_id)
WHERE vm.turn <= fu.ut AND l.split = 'val'
GROUP BY vm.conv_id""")
def q_eval_context(spark, sf_dir):
    val = nested_split(spark, sf_dir, splitting.VAL)
    return rd.eval_prompts(val, ["conv_id"]).select("conv_id", "prompt")


@register("first_user_expected", f"""
WITH {oq.VALID_MSGS_CTE}
SELECT conv_id,
       arg_min(content, turn) FILTER (WHERE role = 'user') AS user_query,
       arg_min(content, turn) FILTER (WHERE role = 'assistant') AS expected
FROM vm GROUP BY conv_id""")
def q_first_user_expected(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return rd.first_user_expected_long(turns, valid_only=True).select(
        "conv_id", "user_query", "expected")


@register("message_preview", f"""
WITH {oq.VALID_MSGS_CTE}
SELECT conv_id, turn,
       '[' || upper(role) || '] ' ||
       CASE WHEN length(content) > 80 THEN substring(content, 1, 80) || '...' ELSE content END AS line
FROM vm""")
def q_message_preview(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").join(
        valid_profile(spark, sf_dir).select("conv_id"), "conv_id", "left_semi")
    return turns.select("conv_id", "turn", F.concat(
        F.lit("["), F.upper("role"), F.lit("] "), preview(py_strip(F.col("text")), 80)).alias("line"))


# ---------------------------------------------------------------------------
# Scoring and perplexity
# ---------------------------------------------------------------------------
def split_texts(spark, sf_dir, split: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """(conv_id, split, split_rank, text) of valid conversations, of one split or both."""
    return rd.chat_text(nested_split(spark, sf_dir, split, labels=labels), ["conv_id", "split", "split_rank"])


def unigram_val_scores(spark, sf_dir) -> DataFrame:
    # The corpus is validated and ranked once; its narrow labels feed fit and scoring,
    # and each split is rendered where it is read (no text is written).
    labels = write_through(conv_split(spark, sf_dir).select("conv_id", "split", "split_rank"), "split-labels")
    scorer = sc.UnigramScorer.fit(split_texts(spark, sf_dir, splitting.TRAIN, labels))
    return scorer.score(split_texts(spark, sf_dir, splitting.VAL, labels), ["conv_id", "split_rank"])


@register("example_scores", f"""
WITH {oq.labelled_text_cte()} {oq.UNIGRAM_SCORES_CTE}
SELECT conv_id, split_rank, round(loss, 6) AS loss, n_tokens FROM sc""")
def q_example_scores(spark, sf_dir):
    s = unigram_val_scores(spark, sf_dir)
    return s.select("conv_id", "split_rank", F.round("loss", 6).alias("loss"), "n_tokens")


@register("perplexity", f"""
WITH {oq.labelled_text_cte()} {oq.UNIGRAM_SCORES_CTE}
SELECT round(exp(sum(loss * n_tokens) / sum(n_tokens)), 4) AS perplexity,
       CAST(sum(n_tokens) AS BIGINT) AS total_tokens,
       CAST(count(*) AS BIGINT) AS num_samples
FROM sc""")
def q_perplexity(spark, sf_dir):
    p = sc.perplexity(unigram_val_scores(spark, sf_dir))
    return p.select(F.round("perplexity", 4).alias("perplexity"), "total_tokens", "num_samples")


@register("running_perplexity", f"""
WITH {oq.labelled_text_cte()} {oq.UNIGRAM_SCORES_CTE},
r AS (SELECT split_rank,
             sum(loss * n_tokens) OVER (ORDER BY split_rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sl,
             sum(n_tokens) OVER (ORDER BY split_rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn
      FROM sc)
SELECT CAST(split_rank AS BIGINT) AS processed, round(exp(sl / sn), 4) AS running_perplexity
FROM r WHERE split_rank % 10 = 0""")
def q_running_perplexity(spark, sf_dir):
    s = unigram_val_scores(spark, sf_dir)
    bucket = md5_bucket(splitting.shuffle_key(F.col("conv_id")))
    r = sc.running_perplexity(s, "split_rank", bucket, materialize_input=True)
    return r.select("processed", F.round("running_perplexity", 4).alias("running_perplexity"))


class LengthScorer:
    """Deterministic stand-in for a user model: loss from the digest of the whole text.

    loss = 1 + (code of the digest's first character % 7) / 10, n_tokens = min(len div 3, 2048).
    """

    def __call__(self, texts):
        return [(1.0 + (ord(hashlib.md5(t.encode()).hexdigest()[0]) % 7) / 10.0, min(len(t) // 3, 2048))
                for t in texts]


@register("user_scorer_perplexity", f"""
WITH {oq.labelled_text_cte()},
s AS (SELECT 1.0 + (ascii(md5(text)) % 7) / 10.0 AS loss, least(length(text) // 3, 2048) AS n
      FROM lt WHERE split = 'val')
SELECT round(exp(sum(loss * n) / sum(n)), 4) AS perplexity,
       CAST(sum(n) AS BIGINT) AS total_tokens, CAST(count(*) AS BIGINT) AS num_samples
FROM s""")
def q_user_scorer_perplexity(spark, sf_dir):
    val = split_texts(spark, sf_dir, splitting.VAL)
    scores = sc.score_with(val, LengthScorer, ["conv_id"])
    p = sc.perplexity(scores)
    return p.select(F.round("perplexity", 4).alias("perplexity"), "total_tokens", "num_samples")


# ---------------------------------------------------------------------------
# Raw JSON ingest on lines derived from the table (fault injection)
# ---------------------------------------------------------------------------
def injected_validated(spark, sf_dir) -> DataFrame:
    lines = inj.damaged_lines(table(spark, sf_dir, "conversations"))
    return va.validate_values(lines)


@register("conv_reject_reasons", f"""
WITH {oq.INJECTED_CTE}
SELECT conv_id, outcome, bad_index FROM expct""")
def q_conv_reject_reasons(spark, sf_dir):
    v = injected_validated(spark, sf_dir)
    return v.select("conv_id", F.coalesce("reason", F.lit("ok")).alias("outcome"),
                    F.coalesce("bad_index", F.lit(-1)).cast("bigint").alias("bad_index"))


@register("conv_normalized", f"""
WITH {oq.INJECTED_CTE}
SELECT c.conv_id,
       CAST(row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) - 1 AS BIGINT) AS turn,
       c.role, {oq.strip('c.text')} AS content
FROM conversations c JOIN expct e ON c.conv_id = e.conv_id
WHERE e.outcome = 'ok'""")
def q_conv_normalized(spark, sf_dir):
    acc = va.accepted(injected_validated(spark, sf_dir), ["conv_id"])
    return conv.to_long(acc).select("conv_id", "turn", "role", "content")


def _write_injected_jsonl(spark, sf_dir, name: str) -> str:
    """Damaged lines written as text files under grp=<conv_id % 3>/ folders."""
    path = scratch_path(spark, name)
    lines = inj.damaged_lines(table(spark, sf_dir, "conversations"))
    (lines.withColumn("grp", F.col("conv_id") % 3).select("grp", "value")
     .write.partitionBy("grp").mode("overwrite").text(path))
    return path


def ingested_groups(spark, sf_dir) -> DataFrame:
    path = _write_injected_jsonl(spark, sf_dir, "jsonl-files")
    v = prep.ingest(spark, path, jsonl_glob="*.txt", json_glob=None, recursive=True)
    return v.withColumn("file_group", F.regexp_extract("file_path", r"grp=(\d+)", 1).try_cast("bigint"))


@register("file_audit", f"""
WITH {oq.INJECTED_CTE}
SELECT CAST(conv_id % 3 AS BIGINT) AS file_group,
       CAST(count(*) FILTER (WHERE outcome <> 'parse_error') AS BIGINT) AS raw_objects,
       CAST(count(*) FILTER (WHERE outcome = 'parse_error') AS BIGINT) AS parse_errors,
       CAST(count(*) FILTER (WHERE outcome = 'ok') AS BIGINT) AS valid_conversations
FROM expct GROUP BY 1""")
def q_file_audit(spark, sf_dir):
    return st.file_audit(ingested_groups(spark, sf_dir), by="file_group")


@register("reject_counts", f"""
WITH {oq.INJECTED_CTE}
SELECT CAST(conv_id % 3 AS BIGINT) AS file_group, outcome AS reason, CAST(count(*) AS BIGINT) AS n
FROM expct WHERE outcome <> 'ok' GROUP BY 1, 2""")
def q_reject_counts(spark, sf_dir):
    return st.reject_counts(ingested_groups(spark, sf_dir), by=("file_group",))


@register("mixed_json_objects", f"""
WITH {oq.INJECTED_MIXED_CTE}
SELECT conv_id, outcome, errors_before FROM expct""")
def q_mixed_json_objects(spark, sf_dir):
    path = scratch_path(spark, "mixed-files")
    lines = inj.damaged_lines(table(spark, sf_dir, "conversations"), pretty=True,
                              with_id=True, allow_truncation=False)
    text = F.concat(F.when(F.col("dmg").isin(1, 2), F.lit("@@ ")).otherwise(F.lit("")),
                    F.col("value"), F.lit(","))
    (lines.select((F.col("conv_id") % 3).alias("grp"), text.alias("value"))
     .write.partitionBy("grp").mode("overwrite").text(path))
    v = prep.ingest(spark, path, jsonl_glob=None, json_glob="*.txt", recursive=True)
    return v.select(F.try_variant_get(F.try_parse_json("value"), "$.id", "bigint").alias("conv_id"),
                    F.coalesce("reason", F.lit("ok")).alias("outcome"),
                    F.col("errors_before").cast("bigint").alias("errors_before"))


@register("stream_ingest", f"""
WITH {oq.INJECTED_CTE}
SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM expct GROUP BY outcome""")
def q_stream_ingest(spark, sf_dir):
    src = scratch_path(spark, "stream-src")
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    (inj.damaged_lines(table(spark, sf_dir, "conversations")).select("value")
     .write.mode("overwrite").text(src))
    q = stream.start_ingest(spark, src, out, ckpt, glob="*.txt")
    q.awaitTermination()
    v = (stream.accepted_conversations(spark, out).select(F.lit("ok").alias("outcome"))
         .unionByName(stream.rejected_values(spark, out).select(F.col("reason").alias("outcome"))))
    return v.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("jsonl_roundtrip", f"""
WITH {oq.labelled_text_cte()}
SELECT l.split_rank AS position, v.n_messages, v.n_chars, md5(lt.text) AS text_md5
FROM labelled l JOIN valid v USING (conv_id) JOIN lt USING (conv_id)
WHERE l.split = 'train'""")
def q_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "train-jsonl")
    s = nested_split(spark, sf_dir, splitting.TRAIN)
    pr.write_jsonl(s, path, order="split_rank")
    back = pr.read_processed(spark, path)
    ranked = pr.dataset_order(back, "position")
    # Both summaries are row-local: one projection, no self-join.
    with_text = ranked.withColumn("text_md5", F.md5(CHATML.render(F.col("messages"))))
    return va.profile_conversations(with_text, ["position", "text_md5"]).select(
        "position", "n_messages", "n_chars", "text_md5")


# ---------------------------------------------------------------------------
# Generation, review, replay, curated documents
# ---------------------------------------------------------------------------
@register("batch_generate", f"""
WITH p AS (
  SELECT conv_id, turn,
         {oq.chatml("'system'", "'You are a helpful assistant.'")} ||
         {oq.chatml("'user'", oq.strip('text'))} || {oq.GEN_PROMPT} AS prompt
  FROM conversations WHERE role = 'user' AND length({oq.strip('text')}) > 0)
SELECT conv_id, turn, {oq.echo_generated('prompt')} AS generated FROM p""")
def q_batch_generate(spark, sf_dir):
    prompts = q_query_prompts(spark, sf_dir)
    return gen.batch_generate(prompts, gen.EchoGenerator, ["conv_id", "turn"])


REVIEW_COLUMNS = ["split_rank", "user_query", "expected", "generated",
                  "user_preview", "expected_preview", "generated_preview"]


@register("review_report", f"""
WITH {oq.labelled_text_cte()} {oq.EVAL_CTE}
SELECT {oq.REVIEW_SELECT} FROM rv""")
def q_review_report(spark, sf_dir):
    val = nested_split(spark, sf_dir, splitting.VAL)
    return rv.review_table(val, "split_rank", gen.EchoGenerator).select(*REVIEW_COLUMNS)


@register("review_sample", f"""
WITH {oq.labelled_text_cte()} {oq.EVAL_CTE}
SELECT {oq.REVIEW_SELECT} FROM rv WHERE split_rank <= 5""")
def q_review_sample(spark, sf_dir):
    # The sample size is the feature here (first num_samples=5 in dataset order).
    val = nested_split(spark, sf_dir, splitting.VAL)
    return rv.review_table(val, "split_rank", gen.EchoGenerator, num_samples=5).select(*REVIEW_COLUMNS)


def replay_log(spark, sf_dir) -> DataFrame:
    c = F.col("conv_id")
    t = F.col("turn")
    text = (F.when((c * 7 + t) % 13 == 5, F.lit("reset"))
            .when((c * 7 + t) % 13 == 9, F.lit(" Reset "))
            .when((c * 3 + t) % 29 == 7, F.lit("quit"))
            .when((c + t) % 31 == 11, F.lit(" EXIT"))
            .when((c + t) % 17 == 3, F.lit("   "))
            .otherwise(F.col("text")))
    return table(spark, sf_dir, "conversations").select(
        (F.floor(c / 4)).cast("bigint").alias("session"),
        (c * 1000 + t).cast("bigint").alias("line_no"), text.alias("text"))


@register("chat_replay", f"""
WITH {oq.REPLAY_LOG_CTE}
SELECT session, segment, position, 'user' AS role, content FROM u
UNION ALL
SELECT DISTINCT session, segment, CAST(0 AS BIGINT) AS position, 'system' AS role,
       'You are a helpful assistant.' AS content
FROM u""")
def q_chat_replay(spark, sf_dir):
    return rp.replay_sessions(replay_log(spark, sf_dir))


@register("curated_chats", f"""
WITH {oq.VALID_MSGS_CTE},
t AS (SELECT conv_id, turn, role, content,
             lead(content) OVER (PARTITION BY conv_id ORDER BY turn) AS reply,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS reply_role
      FROM vm)
SELECT conv_id, turn, content AS user_text, reply AS assistant_text
FROM t WHERE role = 'user' AND reply_role = 'assistant'""")
def q_curated_chats(spark, sf_dir):
    # Every user turn that an assistant turn follows is written as one curated block.
    path = scratch_path(spark, "curated-md")
    turns = table(spark, sf_dir, "conversations").join(
        valid_profile(spark, sf_dir).select("conv_id"), "conv_id", "left_semi")
    follows = Window.partitionBy("conv_id").orderBy("turn")
    pairs = (turns.withColumn("reply", F.lead("text").over(follows))
             .withColumn("reply_role", F.lead("role").over(follows))
             .where("role = 'user' and reply_role = 'assistant'"))
    block = F.concat(F.lit("### Conversation "), F.col("conv_id").cast("string"), F.lit("."),
                     F.col("turn").cast("string"), F.lit("\n**User:** "), py_strip(F.col("text")),
                     F.lit("\n\n**Assistant:** "), py_strip(F.col("reply")), F.lit("\n\n---"))
    (pairs.select((F.col("conv_id") % 3).alias("grp"), block.alias("value"))
     .write.partitionBy("grp").mode("overwrite").text(path))
    docs = (spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true")
            .text(path, wholetext=True)
            .select(F.col("_metadata.file_name").alias("file_name"), "value"))
    parsed = cur.parse_curated(docs)
    return parsed.select(
        F.regexp_extract("title", r"(\d+)\.(\d+)", 1).try_cast("bigint").alias("conv_id"),
        F.regexp_extract("title", r"(\d+)\.(\d+)", 2).try_cast("bigint").alias("turn"),
        F.col("messages")[0]["content"].alias("user_text"),
        F.col("messages")[1]["content"].alias("assistant_text"))


@register("split_overlap", f"""
WITH {oq.labelled_text_cte()},
k AS (SELECT md5(text) AS h, count(*) FILTER (WHERE split = 'train') AS t,
             count(*) FILTER (WHERE split = 'val') AS v
      FROM lt GROUP BY md5(text))
SELECT CAST(sum(t) AS BIGINT) AS n_train, CAST(sum(v) AS BIGINT) AS n_val,
       CAST(count(*) FILTER (WHERE t > 0 AND v > 0) AS BIGINT) AS n_shared_keys
FROM k""")
def q_split_overlap(spark, sf_dir):
    # Duplicates are kept (as in the reference) and may cross the split;
    # this reports how many distinct conversation texts appear on both sides.
    return splitting.split_overlap(split_texts(spark, sf_dir), F.md5("text"))


@register("prepare_job", f"""
WITH {oq.INJECTED_CTE},
ok AS (SELECT p.* FROM prof p JOIN expct e USING (conv_id) WHERE e.outcome = 'ok'),
s AS (SELECT {oq.STATS_SELECT} FROM ok)
SELECT s.*,
       CAST(floor(CAST(conversations AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.1 AS DOUBLE))) AS BIGINT) AS n_train,
       CAST(conversations - floor(CAST(conversations AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.1 AS DOUBLE))) AS BIGINT) AS n_val
FROM s""")
def q_prepare_job(spark, sf_dir):
    # The whole preparation job on raw JSONL files derived from the table;
    # the written split files are read back and summarised.
    raw_dir = _write_injected_jsonl(spark, sf_dir, "prepare-raw")
    out = scratch_path(spark, "prepare-out")
    prep.prepare_data(spark, raw_dir, out, val_ratio=0.1, seed=42, jsonl_glob="*.txt",
                      json_glob=None, recursive=True)
    parts = []
    for name, label in (("train.jsonl", "train"), ("val.jsonl", "val")):
        back = pr.read_processed(spark, f"{out}/{name}", with_order=False)
        parts.append(va.profile_conversations(back, []).withColumn("split", F.lit(label)))
    both = parts[0].unionByName(parts[1])
    return both.agg(*st.stat_exprs(), F.count_if(F.col("split") == "train").alias("n_train"),
                    F.count_if(F.col("split") == "val").alias("n_val"))


# ---------------------------------------------------------------------------
# Whole jobs on files: large and damaged files, rejects, the report
# ---------------------------------------------------------------------------
@contextmanager
def split_size(spark, size: str):
    """A small input-split size while files are read, so that files span many splits."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _write_mixed_files(spark, sf_dir, name: str) -> str:
    """Three files of pretty-printed values in conv_id order; before the values of
    cases 1 and 2 stand two closing brackets that belong to nothing."""
    path = scratch_path(spark, name)
    lines = inj.damaged_lines(table(spark, sf_dir, "conversations"), pretty=True,
                              with_id=True, allow_truncation=False)
    text = F.concat(F.when(F.col("dmg").isin(1, 2), F.lit("}\n] ")).otherwise(F.lit("")),
                    F.col("value"), F.lit(","))
    (lines.select((F.col("conv_id") % 3).alias("grp"), "conv_id", text.alias("value"))
     .repartition(3, "grp").sortWithinPartitions("grp", "conv_id").select("grp", "value")
     .write.partitionBy("grp").mode("overwrite").text(path))
    return path


@register("mixed_json_large", f"""
WITH {oq.INJECTED_MIXED_CTE}
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id % 3 ORDER BY conv_id) - 1 AS BIGINT) AS object_index,
       outcome, errors_before FROM expct""")
def q_mixed_json_large(spark, sf_dir):
    path = _write_mixed_files(spark, sf_dir, "mixed-large")
    with split_size(spark, "64k"):  # reading is eager
        v = prep.ingest(spark, path, jsonl_glob=None, json_glob="*.txt", recursive=True)
    return v.select(F.try_variant_get(F.try_parse_json("value"), "$.id", "bigint").alias("conv_id"),
                    F.col("object_index"), F.coalesce("reason", F.lit("ok")).alias("outcome"),
                    F.col("errors_before"))


@register("ingest_rejects", f"""
WITH {oq.INJECTED_CTE},
l AS (SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'lines' ELSE 'values' END AS folder, outcome, bad_index
      FROM expct WHERE conv_id % 2 = 0 OR m NOT IN (1, 2)),
n AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY conv_id) AS pos,
             count(*) FILTER (WHERE outcome <> 'parse_error') OVER (PARTITION BY folder ORDER BY conv_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counted
      FROM l)
SELECT folder, outcome AS reason, bad_index,
       CAST(CASE WHEN outcome <> 'parse_error' THEN counted - 1 ELSE -1 END AS BIGINT) AS object_index,
       CAST(CASE WHEN folder = 'lines' THEN 2 * pos - 1 ELSE -1 END AS BIGINT) AS line_no
FROM n WHERE outcome <> 'ok'""")
def q_ingest_rejects(spark, sf_dir):
    # One folder with files of both kinds and blank lines between the lines of the
    # one; the kinds are told apart by part number, the writer's only choice of name.
    path = scratch_path(spark, "both-kinds")
    lines = inj.damaged_lines(table(spark, sf_dir, "conversations"))
    odd = F.col("conv_id") % 2
    text = F.when(odd == 0, F.concat(F.col("value"), F.lit("\n \t"))).otherwise(F.col("value"))
    (lines.where((odd == 0) | ~F.col("dmg").isin(1, 2))
     .select(odd.alias("kind"), "conv_id", text.alias("value"))
     .repartitionByRange(2, "kind").sortWithinPartitions("conv_id").select("value")
     .write.mode("overwrite").text(path))
    with split_size(spark, "64k"):
        v = prep.ingest(spark, path, jsonl_glob="part-00000*", json_glob="part-00001*")
    rejects = va.rejected(v, ["file_name", "object_index", "line_no"])
    return rejects.select(
        F.when(F.col("file_name").startswith("part-00000"), F.lit("lines")).otherwise(F.lit("values")).alias("folder"),
        "reason", F.coalesce("bad_index", F.lit(-1)).cast("bigint").alias("bad_index"),
        F.coalesce("object_index", F.lit(-1)).alias("object_index"),
        F.coalesce("line_no", F.lit(-1)).alias("line_no"))


@register("folder_order", f"""
WITH {oq.labelled_text_cte()}
SELECT CAST(row_number() OVER (ORDER BY split, split_rank) AS BIGINT) AS position, md5(text) AS text_md5
FROM lt""")
def q_folder_order(spark, sf_dir):
    # Two folders whose files have the same names: order and keys stay unique.
    root = scratch_path(spark, "two-folders")
    for label in (splitting.TRAIN, splitting.VAL):
        pr.write_jsonl(nested_split(spark, sf_dir, label), f"{root}/part={label}", order="split_rank")
    both = pr.dataset_order(pr.read_processed(spark, root), "position")
    return both.select("position", F.md5(CHATML.render(F.col("messages"))).alias("text_md5"))


@register("eval_report", f"""
WITH {oq.labelled_text_cte()} {oq.EVAL_CTE},
k AS (SELECT *, row_number() OVER (ORDER BY split_rank) AS pos FROM rv),
x AS (SELECT 1.0 + (split_rank % 7) / 10.0 AS loss, 10 + split_rank % 5 AS n FROM lt WHERE split = 'val')
SELECT (SELECT round(exp(sum(loss * n) / sum(n)), 4) FROM x) AS perplexity,
       (SELECT CAST(count(*) AS BIGINT) FROM lt WHERE split = 'val') AS num_val_samples,
       CAST(pos - 1 AS BIGINT) AS position, user_query, expected, generated
FROM k""")
def q_eval_report(spark, sf_dir):
    # The evaluation job on a written validation split, with scores made elsewhere
    # (by key), every example reviewed; its report file is read back.
    root = scratch_path(spark, "eval-report")
    val = nested_split(spark, sf_dir, splitting.VAL)
    pr.write_jsonl(val, f"{root}/val.jsonl", order="split_rank")
    ordered = pr.dataset_order(pr.read_processed(spark, f"{root}/val.jsonl"))
    scores = ordered.select("file_name", "line_index", (F.lit(1.0) + F.col("example") % 7 / 10.0).alias("loss"),
                            (F.lit(10) + F.col("example") % 5).alias("n_tokens"))
    ev.evaluate(spark, f"{root}/val.jsonl", gen.EchoGenerator, scores_table=scores, num_samples=None,
                output=f"{root}/report.json")
    doc = spark.read.schema("perplexity double, num_val_samples bigint, sample_responses array<struct<"
                            "user_query: string, expected: string, generated: string>>").json(
        f"{root}/report.json", multiLine=True)
    return (doc.select("perplexity", "num_val_samples", F.posexplode("sample_responses").alias("position", "s"))
            .select(F.round("perplexity", 4).alias("perplexity"), "num_val_samples",
                    F.col("position").cast("bigint").alias("position"), "s.user_query", "s.expected", "s.generated"))


@register("curated_turns", f"""
WITH {oq.VALID_MSGS_CTE},
t AS (SELECT * FROM vm WHERE role = 'user' OR (role = 'assistant' AND conv_id % 5 <> 0)),
g AS (SELECT conv_id, CAST(count(*) AS BIGINT) AS n_messages, count(*) FILTER (WHERE role = 'assistant') AS replies,
             md5(string_agg(role || ':' || content, chr(10) ORDER BY turn)) AS turns_md5
      FROM t GROUP BY conv_id)
SELECT conv_id, n_messages, turns_md5,
       CASE WHEN n_messages < 2 THEN 'messages_not_list_or_short'
            WHEN replies = 0 THEN 'missing_user_or_assistant' ELSE 'ok' END AS outcome
FROM g""")
def q_curated_turns(spark, sf_dir):
    # Every valid conversation is one curated block of all its user and assistant turns;
    # each fifth loses its replies and must be rejected.
    path = scratch_path(spark, "curated-turns")
    label = F.when(F.col("m.role") == "user", F.lit("User")).otherwise(F.lit("Assistant"))
    turns = (valid_nested(spark, sf_dir).select("conv_id", F.posexplode("messages").alias("pos", "m"))
             .where("m.role = 'user' or (m.role = 'assistant' and conv_id % 5 <> 0)")
             .select("conv_id", F.struct("pos", F.concat(F.lit("**"), label, F.lit(":** "), F.col("m.content"))
                                         .alias("line")).alias("t")))
    blocks = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        (F.col("conv_id") % 3).alias("grp"),
        F.concat(F.lit("### Conversation "), F.col("conv_id").cast("string"), F.lit("\n"),
                 F.array_join(F.col("t.line"), "\n\n"), F.lit("\n\n---")).alias("value"))
    blocks.write.partitionBy("grp").mode("overwrite").text(path)
    docs = (spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true")
            .text(path, wholetext=True)
            .select(F.col("_metadata.file_name").alias("file_name"), "value"))
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    parsed = cur.parse_curated(docs).select(
        F.regexp_extract("title", r"(\d+)", 1).cast("bigint").alias("conv_id"), "messages",
        F.size("messages").cast("bigint").alias("n_messages"), F.md5(lines).alias("turns_md5"))
    return va.validate_typed(parsed).select("conv_id", "n_messages", "turns_md5",
                                            F.coalesce("reason", F.lit("ok")).alias("outcome"))


@register("invalid_utf8", f"""
WITH {oq.VALID_MSGS_CTE},
f AS (SELECT conv_id, arg_min(content, turn) AS content, bool_or(contains(content, chr(65533))) AS had
      FROM vm GROUP BY conv_id),
r AS (SELECT unnest(['lines', 'values']) AS reader)
SELECT reader, conv_id, CASE WHEN conv_id % 3 < 2 THEN chr(65533) ELSE '' END || content AS first_content,
       had OR conv_id % 3 < 2 AS replaced
FROM f CROSS JOIN r""")
def q_invalid_utf8(spark, sf_dir):
    # A lone byte, or the beginning of a character that goes no further, before the first
    # content of two conversations in three; the same bytes as lines and as values.
    line = F.to_json(F.struct(F.col("conv_id").alias("id"), "messages"))
    at = F.instr(line, '"content":"') + F.lit(len('"content":"') - 1)
    bad = (F.when(F.col("conv_id") % 3 == 0, F.unhex(F.lit("FF")))
           .when(F.col("conv_id") % 3 == 1, F.unhex(F.lit("E4B8"))).otherwise(F.unhex(F.lit(""))))
    damaged = F.concat(F.substring(line, F.lit(1), at).cast("binary"), bad,
                       F.substring(line, at + 1, F.length(line)).cast("binary")).cast("string")
    path = scratch_path(spark, "invalid-bytes")
    valid_nested(spark, sf_dir).select(damaged.alias("value")).write.mode("overwrite").text(path)
    lines = prep.ingest(spark, path, jsonl_glob="*.txt", json_glob=None).withColumn("reader", F.lit("lines"))
    values = prep.ingest(spark, path, jsonl_glob=None, json_glob="*.txt").withColumn("reader", F.lit("values"))
    return lines.unionByName(values).where("reason is null").select(
        "reader", F.get_json_object("value", "$.id").cast("bigint").alias("conv_id"),
        F.col("messages")[0]["content"].alias("first_content"), "replaced")


@register("split_preview", f"""
WITH {oq.labelled_text_cte()}
SELECT split, substring(text, 1, 500) AS preview FROM lt WHERE split_rank = 1""")
def q_split_preview(spark, sf_dir):
    # The first formatted example of each written split (a report of one row each).
    root = scratch_path(spark, "preview")
    out = None
    for label in (splitting.TRAIN, splitting.VAL):
        pr.write_jsonl(nested_split(spark, sf_dir, label), f"{root}/{label}", order="split_rank")
        texts = tt.training_texts(pr.read_processed(spark, f"{root}/{label}"), max_tokens=None)
        part = tt.first_text_preview(texts).select(F.lit(label).alias("split"), "preview")
        out = part if out is None else out.unionByName(part)
    return out


@register("running_sums", f"""
WITH {oq.PROFILE_CTE}, {oq.split_cte()}
SELECT conv_id, split, split_rank,
       CAST(sum(n_chars) OVER (PARTITION BY split ORDER BY split_rank) AS BIGINT) AS run_chars,
       CAST(sum(n_messages) OVER (PARTITION BY split ORDER BY split_rank) AS BIGINT) AS run_messages
FROM labelled""")
def q_running_sums(spark, sf_dir):
    # Blocks of two rows, gathered three at a time: four levels at any input size.
    s = conv_split(spark, sf_dir).select("conv_id", "split", "split_rank", "n_chars", "n_messages")
    r = running_within(s, "split", "split_rank", F.expr("(split_rank - 1) div 2"), ["n_chars", "n_messages"],
                       fan=3, levels=4, materialize_input=True)
    return r.select("conv_id", "split", "split_rank", F.col("run_n_chars").cast("bigint").alias("run_chars"),
                    F.col("run_n_messages").cast("bigint").alias("run_messages"))


@register("single_answer", f"""
SELECT conv_id, turn, {oq.echo_generated('prompt')} AS answer
FROM (SELECT conv_id, turn,
             {oq.chatml("'system'", "'You are a helpful assistant.'")} ||
             {oq.chatml("'user'", oq.strip('text'))} || {oq.GEN_PROMPT} AS prompt
      FROM conversations WHERE role = 'user' AND length({oq.strip('text')}) > 0
      ORDER BY conv_id, turn LIMIT 1)""")
def q_single_answer(spark, sf_dir):
    # The single-query job, asked the corpus' first user message.
    asked = (table(spark, sf_dir, "conversations")
             .where((F.col("role") == "user") & ~is_blank(F.col("text")))
             .agg(F.min(F.struct("conv_id", "turn", py_strip(F.col("text")).alias("text"))).alias("q"))
             .where("q is not null").select("q.*").first())
    rows = [] if asked is None else [(asked["conv_id"], asked["turn"],
                                      inf.answer_one(spark, asked["text"], gen.EchoGenerator))]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, answer string")


@register("limited_perplexity", f"""
WITH {oq.labelled_text_cte()},
s AS (SELECT split_rank, 1.0 + (ascii(md5(substring(text, 1, 6144))) % 7) / 10.0 AS loss,
             least(length(substring(text, 1, 6144)) // 3, 2048) AS n
      FROM lt WHERE split = 'val' AND split_rank <= 7),
r AS (SELECT split_rank, sum(loss * n) OVER (ORDER BY split_rank) AS sl, sum(n) OVER (ORDER BY split_rank) AS sn
      FROM s)
SELECT CAST(split_rank AS BIGINT) AS processed, printf('%.2f', exp(sl / sn)) AS running_display,
       (SELECT round(exp(sum(loss * n) / sum(n)), 4) FROM s) AS perplexity,
       (SELECT CAST(count(*) AS BIGINT) FROM lt WHERE split = 'val') AS num_val_samples
FROM r WHERE split_rank % 2 = 0""")
def q_limited_perplexity(spark, sf_dir):
    # The evaluation job over the first seven examples of a written validation split (the
    # limit is the feature): the report's perplexity beside the running values as shown.
    root = scratch_path(spark, "limited")
    pr.write_jsonl(nested_split(spark, sf_dir, splitting.VAL), f"{root}/val.jsonl", order="split_rank")
    ev.evaluate(spark, f"{root}/val.jsonl", gen.EchoGenerator, scorer_factory=LengthScorer, max_samples=7,
                running_every=2, output=f"{root}/report.json")
    report = spark.read.schema("perplexity double, num_val_samples bigint").json(
        f"{root}/report.json", multiLine=True).first()
    return spark.read.parquet(f"{root}/report.json_running").select(
        "processed", "running_display", F.round(F.lit(report["perplexity"]).cast("double"), 4).alias("perplexity"),
        F.lit(report["num_val_samples"]).cast("bigint").alias("num_val_samples"))


@register("report_names", """
SELECT event_id, 'eval_results_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS report_name FROM events""")
def q_report_names(spark, sf_dir):
    # The name of a report that is written at an event's time.
    name = F.concat(F.lit("eval_results_"), timestamp_suffix("ts"), F.lit(".json"))
    return table(spark, sf_dir, "events").select("event_id", name.alias("report_name"))


@register("empty_corpus", f"""
WITH {oq.INJECTED_CTE},
k AS (SELECT 'all' AS lines, outcome FROM expct
      UNION ALL SELECT 'damaged', outcome FROM expct WHERE m BETWEEN 1 AND 9)
SELECT lines, CAST(count(*) AS BIGINT) AS n,
       CASE WHEN count(*) FILTER (WHERE outcome = 'ok') = 0 THEN 'no valid conversations found'
            ELSE 'prepared' END AS outcome
FROM k GROUP BY lines""")
def q_empty_corpus(spark, sf_dir):
    # The preparation job stops when no line is left, as with the damaged ones alone.
    lines = inj.damaged_lines(table(spark, sf_dir, "conversations"))
    out = None
    for name, chosen in (("all", F.lit(True)), ("damaged", F.col("dmg").between(1, 9))):
        root = scratch_path(spark, f"corpus-{name}")
        lines.where(chosen).select("value").write.mode("overwrite").text(f"{root}/raw")
        try:
            prep.prepare_data(spark, f"{root}/raw", f"{root}/out", jsonl_glob="*.txt", json_glob=None)
            outcome = "prepared"
        except ValueError as e:
            outcome = str(e)
        part = spark.read.text(f"{root}/raw").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("lines"), "n", F.lit(outcome).alias("outcome"))
        out = part if out is None else out.unionByName(part)
    return out


@register("truncate_exact_text")
def q_truncate_exact_text(spark, sf_dir):
    # Real tokens of a public vocabulary: beyond SQL, compared with a plain loop in the tests.
    # The settings name another vocabulary file and its pattern.
    import public_tokenizers
    factory = RankTokenizer(
        spark.conf.get("spark.convforge.tokenizerFile", None) or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        spark.conf.get("spark.convforge.tokenizerPattern", None) or public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rd.truncate_exact(docs, factory).select("doc_id", "text", "n_tokens", "is_truncated")
