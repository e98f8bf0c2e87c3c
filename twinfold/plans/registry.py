"""All registered queries over the reference's operators, with their SQL.

A query is a function of (spark, sf_dir); its name starts with the operator's number in the survey.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from twinfold.plans import catalog_queries, curation_queries, expression_queries, graph_queries, picture_queries, rule_queries

    return (expression_queries, picture_queries, rule_queries, catalog_queries, graph_queries, curation_queries)


def queries() -> dict[str, Query]:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
