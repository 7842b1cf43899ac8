"""Audience profiling and click-model evaluation on Spark DataFrames.

Sub-packages:

- ``functions``  column expressions (JSON field, code lists, id rules, dates, hashing)
- ``sources``    readers for log tables, dictionaries, id lists, report files; publish sinks
- ``operators``  tagging, substring dictionary match, profiles, id matching, evaluation
- ``plans``      the registered query catalogue and its DuckDB oracle SQL
- ``streaming``  incremental per-day profiles with Structured Streaming
"""

from profilekit.vocab import INTERESTS, SCORED_INTERESTS, ZERO_INTERESTS

__all__ = ["INTERESTS", "SCORED_INTERESTS", "ZERO_INTERESTS"]
