"""Replay of chat input logs into conversations (R2).

The reference's terminal loop reads lines, strips them, skips blanks, stops
at ``quit``/``exit``, starts over at ``reset`` and otherwise appends a user
message after the system prompt.  Over a logged table
``(session, line_no, text)`` that is:

* cut at the first quit: running count of quits must still be zero;
* segment number: running count of resets before each line;
* position inside a segment: running count of user lines, minus the count
  before the segment starts (a ``min`` per segment).

Running counts use ``ordering.running_within`` so a session of any size is
processed block by block.  The output stays long (one row per message); a
conversation is never gathered into one row here.  Replies come from
generation (X2), not from the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.functions.text import py_strip
from convforge.operators.ordering import running_within
from convforge.schemas import DEFAULT_SYSTEM_PROMPT, QUIT_COMMANDS, RESET_COMMAND
from convforge.session import materialize

DEFAULT_BLOCK = 10_000


def classify(text_col) -> F.Column:
    s = py_strip(text_col)
    low = F.lower(s)
    return (F.when(F.length(s) == 0, F.lit("blank"))
            .when(low.isin(*QUIT_COMMANDS), F.lit("quit"))
            .when(low == RESET_COMMAND, F.lit("reset"))
            .otherwise(F.lit("user")))


def replay_sessions(log: DataFrame, session: str = "session", line_no: str = "line_no",
                    text: str = "text", system_prompt: str = DEFAULT_SYSTEM_PROMPT,
                    block: int = DEFAULT_BLOCK) -> DataFrame:
    """(session, segment, position, role, content) of every replayed
    conversation; position 0 is the system prompt, users follow from 1.
    Segments without a user message produce nothing.

    One two-level running pass counts resets, users and quits per session;
    rows at or after the first quit have a non-zero quit count and drop out.
    The user rows are then written once to the shared checkpoint folder,
    because both the segment starts and the messages are read from them.
    """
    kind = classify(F.col(text))
    k = log.select(session, line_no, kind.alias("kind"), py_strip(F.col(text)).alias("content"))
    flags = (k.withColumn("_is_reset", (F.col("kind") == "reset").cast("bigint"))
             .withColumn("_is_user", (F.col("kind") == "user").cast("bigint"))
             .withColumn("_is_quit", (F.col("kind") == "quit").cast("bigint")))
    run = running_within(flags, session, line_no,
                         F.floor(F.col(line_no) / F.lit(block)).cast("bigint"),
                         ["_is_reset", "_is_user", "_is_quit"])
    users = materialize(
        run.where((F.col("run__is_quit") == 0) & (F.col("kind") == "user"))
        .select(session, F.col("run__is_reset").alias("segment"),
                F.col("run__is_user").alias("_u"), "content"))
    seg_start = users.groupBy(session, "segment").agg(F.min("_u").alias("_u0"))
    msgs = (users.join(seg_start, [session, "segment"])
            .select(session, "segment", (F.col("_u") - F.col("_u0") + 1).alias("position"),
                    F.lit("user").alias("role"), "content"))
    systems = seg_start.select(session, "segment", F.lit(0).cast("bigint").alias("position"),
                               F.lit("system").alias("role"),
                               F.lit(system_prompt).alias("content"))
    return msgs.unionByName(systems)
