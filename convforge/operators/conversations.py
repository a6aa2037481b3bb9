"""Converters between the long turn table and nested conversations.

Long form  (conv_id, turn, role, text)   -- one row per message
Nested     (conv_id, messages ARRAY<STRUCT<role, content>>)

Raw JSON carries a whole conversation in one record, so the nested form is
the natural unit for rendering and writing.  ``to_nested`` assembles it from
the long table with one grouping on ``conv_id``; every size statistic and
validity test on the long table is computed with plain aggregates instead
(``operators.validate.profile_turns``) so those never need the array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_nested(turns: DataFrame, key="conv_id", order: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """Long turns -> one row per conversation (``key``: its key column or columns)
    with an ordered message array.

    Messages keep their raw text; apply ``validate`` for strip / checks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    msg = F.struct(F.col(order).alias("o"),
                   F.struct(F.col(role).alias("role"),
                            F.col(text).alias("content")).alias("m"))
    return (turns.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(msg)).alias("_ms"))
            .select(*keys, F.transform("_ms", lambda x: x["m"]).alias("messages")))


def to_long(conv: DataFrame, keys=("conv_id",), messages: str = "messages") -> DataFrame:
    """Nested conversations -> one row per message with its 0-based index."""
    keys = list(keys)
    return (conv.select(*keys, F.posexplode(messages).alias("turn", "m"))
            .select(*keys, F.col("turn").cast("bigint").alias("turn"),
                    F.col("m.role").alias("role"),
                    F.col("m.content").alias("content")))
