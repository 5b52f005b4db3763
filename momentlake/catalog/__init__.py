"""Registered queries: each a Spark callable and, where SQL can say it, a check text."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

MODULES = ("chat_queries", "fusion_queries", "manifest_queries", "speaker_queries", "context_queries", "scoring_queries", "triage_queries", "text_queries", "stitching_queries", "selection_queries", "profile_queries", "game_queries", "compare_queries", "quality_queries", "source_queries")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
