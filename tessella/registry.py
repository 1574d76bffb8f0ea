"""All queries outside the training-data subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import documents, events, files, graphs, learned, records, relational, texts, vocabulary

FLAGSHIP = "full_outer_merge_ranked_ids"
MODULES = (relational, texts, documents, graphs, events, learned, vocabulary, records, files)


def _all() -> dict[str, tuple]:
    found: dict[str, tuple] = {}
    for module in MODULES:
        twice = found.keys() & module.QUERIES.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        found |= module.QUERIES
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
