"""Registry of the checked queries: each reads the given tables, most have the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a small table that a task turns into pages and parses.
PER_TASK = 4000


def dealt_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks over which the pages of so many parts are dealt."""
    return max(-(-rows // PER_TASK), min(2 * spark.sparkContext.defaultParallelism, rows // 250), 1)


def dealt_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table dealt over tasks whose number grows with it. Its file is a single split, but each of its rows becomes pages whose
    parsing costs far more than reading it; the narrow rows are moved, not the pages."""
    part = table(spark, sf_dir, "part")
    return part.repartition(dealt_tasks(spark, part.count()), "p_partkey")


# rows (page_id, pos, block) of the list entries of the pages, in SQL
LI = """li AS (
  SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, l[i] AS block
  FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li>.*?</li>') AS l FROM pages)))"""

# per page the link targets and link texts of the navigation, in SQL
NAV = """nav AS (
  SELECT page_id, url, regexp_extract_all(html, '(?is)<li><a href="(.*?)">(.*?)</a></li>', 1) AS hrefs,
         regexp_extract_all(html, '(?is)<li><a href="(.*?)">(.*?)</a></li>', 2) AS texts
  FROM pages)"""
