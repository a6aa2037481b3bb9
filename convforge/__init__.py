"""convforge: chat-corpus preparation and evaluation as Spark jobs.

Layout
------
``sources``    readers for raw JSONL / concatenated JSON / processed splits /
               curated Markdown, and the JSONL / report sinks
``functions``  column-expression helpers (Python-compatible strip, strict JSON
               parse, chat templates, display formatting)
``operators``  validation, statistics, exact split, rendering, scoring,
               generation, review and replay, all as DataFrame plans
``plans``      end-to-end jobs (prepare, training text, evaluate, inference)
               and the registered query catalog
``streaming``  incremental file ingest with Structured Streaming
"""

from convforge.session import get_spark, scratch_path  # noqa: F401

__all__ = ["get_spark", "scratch_path"]
