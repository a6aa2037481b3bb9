"""Raw JSON lines derived from the ``conversations`` table, with injected faults.

The test table holds only well-formed conversations, so every reject rule
would go untested.  Each conversation is written as one JSON object and,
depending on ``conv_id % 12``, damaged in one specific way; the expected
outcome is therefore known per conversation and an oracle can state it.
All rows are kept -- damage never removes a conversation.

    m   damage                                   expected outcome
    0   none                                     natural outcome
    1   last 5 characters cut off                parse_error
    2   trailing text ' x'                       parse_error
    3   key 'messages' renamed 'msgs'            no_messages_key
    4   messages is a string                     messages_not_list_or_short
    5   message 1 is a string                    message_not_object, index 1
    6   message 0 lacks 'content'                missing_role_or_content, index 0
    7   last message's role is 'User'            bad_role, index n-1
    8   message 0 content is whitespace only     blank_content, index 0
    9   message 0 content is a number            content_not_string, index 0
    10  every content padded with whitespace     natural outcome, content stripped
    11  extra keys (id, tags, per-message)       natural outcome, extras dropped

(conversations with fewer than two messages give messages_not_list_or_short
for m = 5..9, since the length rule comes first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convforge.operators import conversations as conv

MODULUS = 12
# Padding of case 10 and blank content of case 8 (all Python whitespace).
PAD_LEFT = "  \t"
PAD_RIGHT = "\n 　"
BLANK = " 　 \u001c "


def json_string(s: Column) -> Column:
    """A JSON string literal for ``s`` (Spark's own encoder, brackets removed)."""
    a = F.to_json(F.array(s))
    return F.substring(a, F.lit(2), F.length(a) - 2)


def _message_json(m: Column, i: Column, n: Column, dmg: Column, pretty: bool) -> Column:
    role = F.when((dmg == 7) & (i == n - 1), F.lit("User")).otherwise(m["role"])
    content = (F.when((dmg == 10), F.concat(F.lit(PAD_LEFT), m["content"], F.lit(PAD_RIGHT)))
               .when((dmg == 8) & (i == 0), F.lit(BLANK))
               .otherwise(m["content"]))
    content_json = F.when((dmg == 9) & (i == 0), F.lit("5")).otherwise(json_string(content))
    sep = ",\n    " if pretty else ","
    body = F.concat(F.lit('{"role":'), json_string(role),
                    F.when((dmg == 6) & (i == 0), F.lit(""))
                    .otherwise(F.concat(F.lit(sep + '"content":'), content_json)),
                    F.when(dmg == 11, F.lit(sep + '"extra":1')).otherwise(F.lit("")),
                    F.lit("}"))
    return F.when((dmg == 5) & (i == 1), F.lit('"oops"')).otherwise(body)


def damaged_lines(turns: DataFrame, pretty: bool = False, with_id: bool = False,
                  allow_truncation: bool = True) -> DataFrame:
    """(conv_id, dmg, value): one JSON text per conversation, damaged by case.

    ``pretty`` spreads every object over several lines (for concatenated
    files); ``with_id`` adds an ``id`` key to every object; without
    ``allow_truncation`` cases 1 and 2 get no damage (for concatenated files,
    where cut objects would turn into fragments).
    """
    nested = conv.to_nested(turns).withColumn("dmg", (F.col("conv_id") % MODULUS).cast("int"))
    n = F.size("messages")
    dmg = F.col("dmg")
    msgs = F.transform("messages", lambda m, i: _message_json(m, i, n, dmg, pretty))
    nl = "\n  " if pretty else ""
    arr = F.concat(F.lit("[" + nl), F.array_join(msgs, "," + nl), F.lit("]"))
    key = F.when(dmg == 3, F.lit('"msgs"')).otherwise(F.lit('"messages"'))
    value_json = F.when(dmg == 4, F.lit('"hello"')).otherwise(arr)
    head = F.when(F.lit(with_id) | (dmg == 11),
                  F.concat(F.lit('"id":'), F.col("conv_id").cast("string"),
                           F.when(dmg == 11, F.lit(',"tags":["a","b"]')).otherwise(F.lit("")),
                           F.lit("," + nl))).otherwise(F.lit(""))
    built = nested.select("conv_id", "dmg", F.concat(
        F.lit("{" + nl), head, key, F.lit(":"), value_json, F.lit("}")).alias("value"))
    if not allow_truncation:
        return built
    line = F.col("value")
    return built.withColumn("value", F.when(dmg == 1, F.substring(line, F.lit(1), F.length(line) - 5))
                            .when(dmg == 2, F.concat(line, F.lit(" x")))
                            .otherwise(line))
