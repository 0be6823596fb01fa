"""All registered queries: name -> (Spark callable, SQL text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmart.catalogue import changes, checks, ingestion, marts, monitoring, operations

MODULES = (marts, checks, changes, monitoring, ingestion, operations)

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, tuple[Query, str | None]]:
    found: dict[str, tuple[Query, str | None]] = {}
    for module in MODULES:
        for name, pair in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = pair
    return found
