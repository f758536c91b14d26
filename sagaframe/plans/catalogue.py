"""All queries of the library by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sagaframe.plans import graph_queries, scope_queries, signal_queries, style_queries, text_queries

MODULES = (text_queries, graph_queries, style_queries, signal_queries, scope_queries)
QUERIES: dict = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["scene_pack"](spark, sf_dir)
