"""The registered queries of the engine, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelake.plans import check_queries, layout_queries, order_queries, page_queries, place_queries, questions, row_queries, scan_queries, set_queries, text_queries, volume_queries
from pagelake.streaming import incremental

ALL = set_queries.QUERIES | order_queries.QUERIES | text_queries.QUERIES | page_queries.QUERIES | place_queries.QUERIES | row_queries.QUERIES | check_queries.QUERIES | questions.QUERIES | volume_queries.QUERIES | scan_queries.QUERIES | layout_queries.QUERIES | incremental.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
