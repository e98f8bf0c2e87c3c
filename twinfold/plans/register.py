"""How query modules list their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinfold.plans.fixtures import Catalog, catalog, sql


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Catalog], DataFrame], body: str | None = None, *tables: str) -> None:
        """build gets the catalog; body is DuckDB SQL over the named catalog tables."""
        self.queries[name] = lambda spark, sf_dir: build(catalog(spark, sf_dir))
        if body:
            self.oracles[name] = sql(body, *tables)
