"""All queries of the library by name, with DuckDB SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.plans import annotation_queries, catalog_queries, display_queries, reader_queries, source_queries, story_queries, text_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**text_queries.QUERIES, **story_queries.QUERIES, **catalog_queries.QUERIES, **annotation_queries.QUERIES, **reader_queries.QUERIES, **display_queries.QUERIES, **source_queries.QUERIES}
ORACLE_SQL: dict[str, str] = {**text_queries.ORACLE_SQL, **story_queries.ORACLE_SQL, **catalog_queries.ORACLE_SQL, **annotation_queries.ORACLE_SQL, **reader_queries.ORACLE_SQL, **display_queries.ORACLE_SQL, **source_queries.ORACLE_SQL}
