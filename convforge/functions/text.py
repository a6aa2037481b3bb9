"""Scalar column helpers with Python string semantics.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from convforge.schemas import WS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: trim Python's 29 whitespace code points (F1)."""
    return F.btrim(_c(col), F.lit(WS))


def is_blank(col) -> Column:
    """True when nothing but whitespace remains."""
    return F.length(py_strip(col)) == 0


def preview(col, width: int, always_ellipsis: bool = False) -> Column:
    """Prefix of ``width`` code points plus '...' (F6, F7).

    ``always_ellipsis`` reproduces the review print, which appends the dots
    unconditionally; otherwise they are added only when text was cut.
    """
    c = _c(col)
    head = F.substring(c, 1, width)
    if always_ellipsis:
        return F.concat(head, F.lit("..."))
    return F.when(F.length(c) > width, F.concat(head, F.lit("..."))).otherwise(c)


def or_default(col, default: str) -> Column:
    """``value or default``: NULL and '' both fall back."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default))


def pretty_key(col) -> Column:
    """``key.replace('_', ' ').title()`` for snake-case statistic names."""
    return F.initcap(F.regexp_replace(_c(col), "_", " "))


def thousands(col) -> Column:
    """``f'{v:,}'`` for integers."""
    return F.format_number(_c(col), 0)


def two_decimals(col) -> Column:
    """``f'{x:.2f}'`` for display."""
    return F.format_string("%.2f", _c(col))


def timestamp_suffix(at=None) -> Column:
    """``%Y%m%d_%H%M%S`` of a time, by default the current one."""
    return F.date_format(F.current_timestamp() if at is None else _c(at), "yyyyMMdd_HHmmss")
