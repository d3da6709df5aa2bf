"""The core's queries by name, over the tables of a folder, with their SQL.

Every query runs over its whole tables. Those without SQL are sequential packers or carry Python models; they are
tested against brute force on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import io_queries, pairs_queries, retrieval_queries, training_queries

_PARTS = (pairs_queries, retrieval_queries, training_queries, io_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: q for part in _PARTS for n, (q, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for part in _PARTS for n, (_, s) in part.QUERIES.items() if s}
