"""Registration of queries, and the views that they share: issues, changes and a dump."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import placed  # noqa: F401  the queries' own name for it


class Catalogue:
    """Queries of one family with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, run: Callable, sql: str | None) -> None:
        self.queries[name] = run
        if sql:
            self.sql[name] = sql

    def __call__(self, sql: str | None = None):
        def register(f: Callable) -> Callable:
            self.add(f.__name__, f, sql)
            return f

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_id(key: str) -> Column:
    return F.concat(F.lit("a"), F.lpad(F.lower(F.hex(key)), 31, "0"))


def number(sys_id: str) -> int:
    """The key that an id was made of, so that a lookup by id can be pushed to the scan."""
    return int(sys_id[1:], 16)


def issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a keyed, mutable table of issues."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        hex_id("o_orderkey").alias("sys_id"), F.col("o_orderdate").alias("sys_updated_on"), (F.col("o_custkey") % 5).alias("sys_mod_count"),
        F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("cost"), F.col("o_custkey").alias("caller"), F.col("o_orderkey").alias("number"),
    )


ISSUE = """issue AS (SELECT concat('a', lpad(lower(hex(o_orderkey)), 31, '0')) AS sys_id, o_orderdate AS sys_updated_on, o_custkey % 5 AS sys_mod_count,
 o_orderstatus AS state, o_orderpriority AS priority, o_totalprice AS cost, o_custkey AS caller, o_orderkey AS number FROM orders)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change stream: topic, partition, offset, key, operation header, value."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id") % 5
    return e.select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), hex_id("user_id").alias("id"),
        F.when(n == 0, "CREATE").when(n == 1, "PATCH").when(n == 2, "PUT").when(n == 3, "DELETE").otherwise(F.lit(None)).alias("op"),
        F.col("value").alias("cost"), F.col("props"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("at"),
    )


CHANGES = """changes AS (SELECT event_type AS topic, user_id % 4 AS partition, event_id AS "offset", concat('a', lpad(lower(hex(user_id)), 31, '0')) AS id,
 CASE event_id % 5 WHEN 0 THEN 'CREATE' WHEN 1 THEN 'PATCH' WHEN 2 THEN 'PUT' WHEN 3 THEN 'DELETE' END AS op, value AS cost, props, date_trunc('second', ts)::TIMESTAMP AS "at" FROM events)"""


def dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered versions of issues: some keys lost, some older, some twice, some unknown."""
    i = issue(spark, sf_dir).select("number", "sys_id", F.date_format("sys_updated_on", "yyyy-MM-dd HH:mm:ss").alias("ts"), "sys_mod_count")
    kept = i.filter("number % 97 != 0")
    old = F.col("number") % 89 == 0
    once = kept.select(F.when(F.col("number") % 101 == 0, F.concat(F.lit("f"), F.substring("sys_id", 2, 31))).otherwise(F.col("sys_id")).alias("sys_id"), F.when(old, F.lit("1990-01-01 00:00:00")).otherwise(F.col("ts")).alias("ts"), F.col("sys_mod_count").alias("mod"))
    return once.union(kept.filter("number % 83 = 0 and number % 101 != 0").select("sys_id", "ts", F.col("sys_mod_count").alias("mod")))


DUMP = """kept AS (SELECT number, sys_id, strftime(sys_updated_on, '%Y-%m-%d %H:%M:%S') AS ts, sys_mod_count AS "mod" FROM issue WHERE number % 97 <> 0),
 dump AS (SELECT CASE WHEN number % 101 = 0 THEN concat('f', substr(sys_id, 2, 31)) ELSE sys_id END AS sys_id, CASE WHEN number % 89 = 0 THEN '1990-01-01 00:00:00' ELSE ts END AS ts, "mod" FROM kept
  UNION ALL SELECT sys_id, ts, "mod" FROM kept WHERE number % 83 = 0 AND number % 101 <> 0)"""
