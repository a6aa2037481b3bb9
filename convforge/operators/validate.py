"""Conversation validation and normalisation (P1-P10, P16) with reasons.

Two entry points share one set of rules:

* ``validate_values`` works on raw JSON text (one value per row), typed as
  VARIANT, using higher-order functions on the message array: row-local, no
  shuffle at all.
* ``profile_turns`` works on the long turn table with ordinary aggregates
  grouped by conversation.  Every aggregate is algebraic and fixed-width
  (count, sum, min of a packed BIGINT), so Spark hash-aggregates with
  partial results before the shuffle and a very large conversation costs no
  more than its share of rows.

The first failing rule decides the reason; message rules run in message order
and the first bad message wins.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from convforge.functions.jsonparse import as_object, strict_parse, variant_type
from convforge.functions.text import is_blank, py_strip
from convforge.schemas import MIN_MESSAGES, ROLES

# Reject reasons, in rule order.
PARSE_ERROR = "parse_error"
# From this size on a value may be beyond Spark's VARIANT limit.
VARIANT_LIMIT_BYTES = 16 * 1024 * 1024
NO_MESSAGES_KEY = "no_messages_key"
NOT_LIST_OR_SHORT = "messages_not_list_or_short"
NOT_OBJECT = "message_not_object"
MISSING_ROLE_OR_CONTENT = "missing_role_or_content"
BAD_ROLE = "bad_role"
CONTENT_NOT_STRING = "content_not_string"
BLANK_CONTENT = "blank_content"
MISSING_USER_OR_ASSISTANT = "missing_user_or_assistant"

REASONS = (PARSE_ERROR, NO_MESSAGES_KEY, NOT_LIST_OR_SHORT, NOT_OBJECT,
           MISSING_ROLE_OR_CONTENT, BAD_ROLE, CONTENT_NOT_STRING,
           BLANK_CONTENT, MISSING_USER_OR_ASSISTANT)


def fence(df: DataFrame) -> DataFrame:
    """Stop predicates from being pushed into the validation expressions.

    A filter on ``reason`` would otherwise be pushed below the projections
    and the whole parse-and-check expression substituted into it (and
    evaluated again per reference).  Emitting the row through a one-element
    ``inline`` generator makes every column generator output, which
    predicate pushdown cannot cross, so the checks run once per row.
    """
    cols = df.columns
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in cols]))))


def _role_ok(role_col):
    return F.coalesce(role_col.isin(*ROLES), F.lit(False))


def _message_reason(obj):
    """Reason for one message given as MAP<STRING, VARIANT> (NULL if fine)."""
    role = F.try_variant_get(obj["role"], "$", "string")
    content = obj["content"]
    content_str = F.try_variant_get(content, "$", "string")
    return (F.when(obj.isNull(), F.lit(NOT_OBJECT))
            .when(~(F.map_contains_key(obj, "role") & F.map_contains_key(obj, "content")),
                  F.lit(MISSING_ROLE_OR_CONTENT))
            .when(~_role_ok(role), F.lit(BAD_ROLE))
            .when(variant_type(content) != "STRING", F.lit(CONTENT_NOT_STRING))
            .when(is_blank(content_str), F.lit(BLANK_CONTENT)))


def _judge(text: str) -> tuple:
    """(reason, bad_index, messages) of one JSON text, for ``_judged`` only."""
    def clean(s):  # unpaired surrogates have no UTF-8 form
        return s.strip().encode("utf-8", "replace").decode()

    try:
        value = json.loads(text.strip(), parse_constant=lambda _: None)
    except (ValueError, RecursionError):
        return PARSE_ERROR, None, None
    if not (isinstance(value, dict) and "messages" in value):
        return NO_MESSAGES_KEY, None, None
    items = value["messages"]
    if not isinstance(items, list) or len(items) < MIN_MESSAGES:
        return NOT_LIST_OR_SHORT, None, None
    tests = ((lambda m: isinstance(m, dict), NOT_OBJECT),
             (lambda m: {"role", "content"} <= m.keys(), MISSING_ROLE_OR_CONTENT),
             (lambda m: isinstance(m["role"], str) and m["role"] in ROLES, BAD_ROLE),
             (lambda m: isinstance(m["content"], str), CONTENT_NOT_STRING),
             (lambda m: m["content"].strip() != "", BLANK_CONTENT))
    for i, m in enumerate(items):
        fault = next((reason for holds, reason in tests if not holds(m)), None)
        if fault:
            return fault, i, None
    if not {"user", "assistant"} <= {m["role"] for m in items}:
        return MISSING_USER_OR_ASSISTANT, None, None
    return None, None, [{"role": m["role"], "content": clean(m["content"])} for m in items]


_JUDGED = StructType([
    StructField("reason", StringType()), StructField("bad_index", IntegerType()),
    StructField("messages", ArrayType(StructType([StructField("role", StringType()),
                                                  StructField("content", StringType())])))])


@F.pandas_udf(_JUDGED)
def _judged(texts: pd.Series) -> pd.DataFrame:
    """The same rules in Python, for the few values that VARIANT cannot hold: very
    large ones and ones with NaN or Infinity, which count as null.  Other rows
    come as NULL and cost nothing."""
    rows = [(None, None, None) if t is None else _judge(t) for t in texts]
    out = pd.DataFrame(rows, columns=["reason", "bad_index", "messages"])
    return out.astype({"bad_index": "Int32", "reason": "object", "messages": "object"})


def validate_values(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode and check every raw value; add ``reason``, ``bad_index``, ``messages``.

    ``messages`` (ARRAY<STRUCT<role, content>>, content stripped, every other
    key dropped) is set only for accepted rows; ``reason`` is NULL exactly for
    them.  All input columns are kept so rejects can be reported with their
    file and position.
    """
    df = (raw
          .withColumn("_v", strict_parse(F.col(value)))
          .withColumn("_obj", as_object(F.col("_v")))
          .withColumn("_msgs", F.try_variant_get("_v", "$.messages", "array<variant>"))
          .withColumn("_mo", F.transform("_msgs", as_object)))
    df = (df
          .withColumn("_bad", F.try_element_at(
              F.filter(F.transform("_mo", lambda o, i: F.struct(
                  i.alias("i"), _message_reason(o).alias("r"))),
                  lambda x: x["r"].isNotNull()),
              F.lit(1)))
          .withColumn("_norm", F.transform("_mo", lambda o: F.struct(
              F.try_variant_get(o["role"], "$", "string").alias("role"),
              py_strip(F.try_variant_get(o["content"], "$", "string")).alias("content")))))
    has_user = F.exists("_norm", lambda m: m["role"] == "user")
    has_asst = F.exists("_norm", lambda m: m["role"] == "assistant")
    text = F.col(value)
    odd = F.col("_v").isNull() & ((F.octet_length(text) >= F.lit(VARIANT_LIMIT_BYTES))
                                  | text.contains("NaN") | text.contains("Infinity"))
    df = df.withColumn("_odd", F.coalesce(odd, F.lit(False)))
    df = df.withColumn("_j", _judged(F.when(F.col("_odd"), text)))
    reason = (F.when(F.col("_odd"), F.col("_j.reason"))
              .when(F.col("_v").isNull(), F.lit(PARSE_ERROR))
              .when(F.col("_obj").isNull() | ~F.map_contains_key("_obj", "messages"),
                    F.lit(NO_MESSAGES_KEY))
              .when(F.col("_msgs").isNull() | (F.size("_msgs") < MIN_MESSAGES),
                    F.lit(NOT_LIST_OR_SHORT))
              .when(F.col("_bad").isNotNull(), F.col("_bad.r"))
              .when(~(has_user & has_asst), F.lit(MISSING_USER_OR_ASSISTANT)))
    return fence(df.withColumn("reason", reason)
                 .withColumn("bad_index", F.when(F.col("_odd"), F.col("_j.bad_index")).when(
                     F.col("reason") == F.col("_bad.r"), F.col("_bad.i")).cast("int"))
                 .withColumn("messages", F.when(F.col("reason").isNull(), F.when(
                     F.col("_odd"), F.col("_j.messages")).otherwise(F.col("_norm"))))
                 .drop("_v", "_obj", "_msgs", "_mo", "_bad", "_norm", "_odd", "_j"))


def validate_typed(conv: DataFrame, messages: str = "messages") -> DataFrame:
    """The same rules for an already typed ARRAY<STRUCT<role, content>>.

    Used for processed split files read with a declared schema and for
    conversations assembled from the long table.  Adds ``reason`` and
    ``bad_index`` and replaces ``messages`` by the normalised array (NULL for
    rejected rows).
    """
    m = F.col(messages)
    bad = F.try_element_at(
        F.filter(F.transform(m, lambda x, i: F.struct(
            i.alias("i"),
            (F.when(x.isNull(), F.lit(NOT_OBJECT))
             .when(~_role_ok(x["role"]), F.lit(BAD_ROLE))
             .when(x["content"].isNull(), F.lit(CONTENT_NOT_STRING))
             .when(is_blank(x["content"]), F.lit(BLANK_CONTENT))).alias("r"))),
            lambda y: y["r"].isNotNull()),
        F.lit(1))
    norm = F.transform(m, lambda x: F.struct(x["role"].alias("role"),
                                             py_strip(x["content"]).alias("content")))
    has_user = F.exists(m, lambda x: x["role"] == "user")
    has_asst = F.exists(m, lambda x: x["role"] == "assistant")
    reason = (F.when(m.isNull() | (F.size(m) < MIN_MESSAGES), F.lit(NOT_LIST_OR_SHORT))
              .when(F.col("_bad").isNotNull(), F.col("_bad.r"))
              .when(~(has_user & has_asst), F.lit(MISSING_USER_OR_ASSISTANT)))
    return fence(conv.withColumn("_bad", bad)
                 .withColumn("reason", reason)
                 .withColumn("bad_index", F.when(F.col("reason") == F.col("_bad.r"),
                                                 F.col("_bad.i")).cast("int"))
                 .withColumn(messages, F.when(F.col("reason").isNull(), norm))
                 .drop("_bad"))


def accepted(validated: DataFrame, keys) -> DataFrame:
    """CONV rows: the keys plus normalised ``messages`` of accepted values (P10)."""
    return validated.where(F.col("reason").isNull()).select(*keys, "messages")


def rejected(validated: DataFrame, keys, value: str = "value") -> DataFrame:
    """REJECT rows: keys, reason, index of the first bad message, raw value."""
    return validated.where(F.col("reason").isNotNull()).select(
        *keys, "reason", "bad_index", value)


# ---------------------------------------------------------------------------
# Nested profile: per-conversation sizes with higher-order functions.
# ---------------------------------------------------------------------------
def _count_role(messages, role):
    return F.size(F.filter(messages, lambda m: m["role"] == role)).cast("bigint")


def profile_conversations(conv: DataFrame, keys, messages: str = "messages") -> DataFrame:
    """Per-conversation counts (P16, A2-A7 inputs) from the nested form."""
    m = F.col(messages)
    return conv.select(
        *keys,
        F.size(m).cast("bigint").alias("n_messages"),
        _count_role(m, "system").alias("n_system"),
        _count_role(m, "user").alias("n_user"),
        _count_role(m, "assistant").alias("n_assistant"),
        F.aggregate(m, F.lit(0).cast("bigint"),
                    lambda a, x: a + F.length(x["content"]).cast("bigint")).alias("n_chars"))


# ---------------------------------------------------------------------------
# Long-form profile: validity and sizes with algebraic aggregates.
# ---------------------------------------------------------------------------
def message_reason_long(role: str = "role", text: str = "text"):
    """Reason for a long-form message row (no object/key rules apply)."""
    return (F.when(~_role_ok(F.col(role)), F.lit(BAD_ROLE))
            .when(F.col(text).isNull(), F.lit(CONTENT_NOT_STRING))
            .when(is_blank(F.col(text)), F.lit(BLANK_CONTENT)))


# Codes of message-level reasons, packed with the turn into one BIGINT so
# "reason of the first bad turn" is a plain min() (hash aggregation, no sort).
_MSG_REASONS = (BAD_ROLE, CONTENT_NOT_STRING, BLANK_CONTENT)
_CODE_BITS = 4


def profile_aggregates(order: str = "turn", role: str = "role", text: str = "text") -> list:
    """The per-conversation aggregate expressions of ``profile_turns``, for
    callers that add their own aggregates to the same grouping."""
    r = message_reason_long(role, text)
    code = F.lit(None).cast("bigint")
    for i, name in enumerate(_MSG_REASONS):
        code = F.when(r == name, F.lit(i)).otherwise(code) if i else F.when(r == name, F.lit(i))
    packed = F.shiftleft(F.col(order).cast("bigint"), _CODE_BITS) + code
    return [
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(F.col(role) == "system").alias("n_system"),
        F.count_if(F.col(role) == "user").alias("n_user"),
        F.count_if(F.col(role) == "assistant").alias("n_assistant"),
        F.coalesce(F.sum(F.length(py_strip(F.col(text)))), F.lit(0)).cast("bigint").alias("n_chars"),
        F.min(packed).alias("_bad"),
    ]


def profile_outcome(prof: DataFrame) -> DataFrame:
    """Turn the aggregates of ``profile_aggregates`` into ``reason`` and
    ``bad_turn``."""
    bad_reason = F.element_at(F.array(*[F.lit(x) for x in _MSG_REASONS]),
                              (F.col("_bad") % (1 << _CODE_BITS)).cast("int") + 1)
    reason = (F.when(F.col("n_messages") < MIN_MESSAGES, F.lit(NOT_LIST_OR_SHORT))
              .when(F.col("_bad").isNotNull(), bad_reason)
              .when((F.col("n_user") == 0) | (F.col("n_assistant") == 0),
                    F.lit(MISSING_USER_OR_ASSISTANT)))
    return (prof.withColumn("reason", reason)
            .withColumn("bad_turn", F.when(F.col("_bad").isNotNull() & (F.col("reason") == bad_reason),
                                           F.shiftright(F.col("_bad"), _CODE_BITS)))
            .drop("_bad"))


def profile_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: sizes of the normalised messages plus the
    validation outcome (``reason`` NULL when valid, ``bad_turn`` of the first
    bad message).

    Only fixed-width algebraic aggregates are used, so Spark runs a hash
    aggregate with map-side partial results: the shuffle carries one small
    row per conversation and partition, never message text.
    """
    return profile_outcome(turns.groupBy(key).agg(*profile_aggregates(order, role, text)))
