"""Curated chats written as Markdown.

Blocks are separated by rule lines (``---``); a block has a ``###`` heading
and labelled turns, ``**<user label>:** text`` and
``**<assistant label>:** text`` (texts may span lines), any number in any order.
Each block with a turn becomes a conversation of its turns (plus an optional
system message); the rules of every other source then accept or reject it, so a
lone turn or one without a reply is a reject with a reason.  A block without
turns is prose.  A curated document is hand-written and
small, so each file is read whole; files are read in parallel.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.functions.text import py_strip


def parse_curated(docs: DataFrame, user_label: str = "User",
                  assistant_label: str = "Assistant", system_prompt: str | None = None,
                  text: str = "value") -> DataFrame:
    """(file_name, block_index, title, messages) from whole-document rows; a
    ``file_path`` is carried along."""
    keep = ["file_path"] if "file_path" in docs.columns else []
    u, a = re.escape(user_label), re.escape(assistant_label)
    blocks = docs.select("file_name", *keep, F.posexplode(F.split(F.col(text), r"\n\s*-{3,}\s*(?:\n|$)"))
                         .alias("block_index", "block"))
    label = rf"\*\*({u}|{a}):\*\*"
    turn = rf"(?s){label}(.*?)(?=\*\*(?:{u}|{a}):\*\*|\z)"
    parsed = (blocks.where(F.col("block").rlike(label))
              .select("file_name", *keep, F.col("block_index").cast("int").alias("block_index"),
                      py_strip(F.regexp_extract("block", r"(?m)^###\s*(.*)$", 1)).alias("title"),
                      F.regexp_extract_all("block", F.lit(turn), F.lit(1)).alias("_who"),
                      F.regexp_extract_all("block", F.lit(turn), F.lit(2)).alias("_what")))
    msgs = F.transform("_who", lambda w, i: F.struct(
        F.when(w == user_label, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        py_strip(F.get("_what", i)).alias("content")))
    if system_prompt is not None:
        msgs = F.concat(F.array(F.struct(F.lit("system").alias("role"),
                                         F.lit(system_prompt).alias("content"))), msgs)
    return parsed.select("file_name", *keep, "block_index", "title", msgs.alias("messages"))


def read_curated_markdown(spark: SparkSession, path: str, glob: str = "*.md", **kw) -> DataFrame:
    docs = (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_name").alias("file_name"), "value"))
    return parse_curated(docs, **kw)
