"""The registry of named queries (Spark) and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import array_queries, call_queries, envelope_queries, misc_queries, model_queries, eval_queries, segment_queries, signal_queries, source_queries, stream_queries, text_queries

_MODULES = [call_queries, text_queries, eval_queries, array_queries, signal_queries, segment_queries, stream_queries, envelope_queries, model_queries, misc_queries, source_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
