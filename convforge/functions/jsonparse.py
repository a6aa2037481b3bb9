"""Strict JSON decoding into VARIANT (F15, section 2.11 of the survey).

``try_parse_json`` alone accepts trailing text (``{"a":1}x``, ``{"a":1}{"b":2}``).
Python's ``json.loads`` does not, so a value is accepted only when it also
parses as the single element of an array and as the value of an object
member.  Any trailing text breaks at least one of the two wrappings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from convforge.functions.text import py_strip


def strict_parse(col) -> Column:
    """VARIANT of a JSON text, or NULL if Python's json.loads would reject it.

    Surrounding whitespace is removed first (the line is stripped before
    decoding).  NaN / Infinity literals come out NULL (VARIANT has no such
    values) and are reported as parse errors.
    """
    s = py_strip(col)
    as_array = F.try_parse_json(F.concat(F.lit("["), s, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"r":'), s, F.lit("}")))
    single = F.coalesce(
        F.size(F.try_variant_get(as_array, "$", "array<variant>")) == 1,
        F.lit(False))
    # Two parses per value: the decoded value is the member of the wrapping.
    return F.when(single & as_member.isNotNull() & (F.length(s) > 0),
                  F.try_variant_get(as_member, "$.r", "variant"))


def as_object(v) -> Column:
    """MAP<STRING, VARIANT> when the variant is a JSON object, else NULL."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def variant_type(v) -> Column:
    """Type name of a (scalar) variant: STRING, BIGINT, VOID, OBJECT<...>, ..."""
    return F.schema_of_variant(v)
