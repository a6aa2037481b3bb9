"""Shared helpers for the command-line entry points of the jobs."""

from __future__ import annotations

import importlib


def load_factory(spec: str | None):
    """'package.module:callable' -> the callable (None stays None)."""
    if not spec:
        return None
    mod, _, name = spec.partition(":")
    if not name:
        raise ValueError("expected 'module:callable'")
    return getattr(importlib.import_module(mod), name)


def session(app: str):
    from convforge.session import get_spark
    spark = get_spark(app=app)
    spark.sparkContext.setLogLevel("WARN")
    return spark
