"""What the query modules share: tables, a registry, and the layers that are derived from the tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.partitions import in_parts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: The day that the queries take for today.
TODAY = date(1998, 1, 1)
TODAY_SQL = "DATE '1998-01-01'"
#: Line items of a task: each window over them holds some 100 bytes of one.
ITEMS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return add


#: Orders as edition records: strings to merge, a day, and three layers that differ by what the columns say.
ORDERS_SQL = """o AS (
    SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS place, CAST(o_custkey % 50 AS VARCHAR) AS link,
           CAST(o_orderdate AS DATE) AS day, o_custkey AS cust
    FROM orders)"""
LAYERS_SQL = (
    ORDERS_SQL
    + """, e AS (SELECT k, status, place, link FROM o WHERE place <> '5-LOW'),
    c AS (SELECT k, CASE WHEN place = '1-URGENT' THEN NULL ELSE status || '-up' END AS status, CASE WHEN month(day) <= 4 THEN ' tba ' WHEN month(day) <= 8 THEN place || '!' END AS place, link FROM o WHERE status <> 'P'),
    m AS (SELECT k, CASE status WHEN 'O' THEN 'fixed' WHEN 'F' THEN 'F-up' END AS status, CASE WHEN status = 'F' THEN place || '!' ELSE 'hall ' || link END AS place, CAST(NULL AS VARCHAR) AS link,
                 CASE WHEN month(day) <= 4 THEN ['status'] WHEN month(day) <= 8 THEN ['status', 'place'] ELSE ['place', 'link'] END AS set_fields
          FROM o WHERE day(day) <= 5)"""
)


def editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("place"),
        (F.col("o_custkey") % 50).cast("string").alias("link"), F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("cust"),
    )


def layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Existing, upstream and override records."""
    o, month, lit = editions(spark, sf_dir), F.month("day"), F.lit
    upstream = o.filter("status <> 'P'").select(
        "k", F.when(F.col("place") != "1-URGENT", F.concat("status", lit("-up"))).alias("status"), F.when(month <= 4, " tba ").when(month <= 8, F.concat("place", lit("!"))).alias("place"), "link"
    )
    sets = F.when(month <= 4, F.array(lit("status"))).when(month <= 8, F.array(lit("status"), lit("place"))).otherwise(F.array(lit("place"), lit("link")))
    override = o.filter(F.dayofmonth("day") <= 5).select(
        "k", F.when(F.col("status") == "O", "fixed").when(F.col("status") == "F", "F-up").alias("status"),
        F.when(F.col("status") == "F", F.concat("place", lit("!"))).otherwise(F.concat(lit("hall "), "link")).alias("place"), lit(None).cast("string").alias("link"), sets.alias("set_fields"),
    )
    return o.filter("place <> '5-LOW'").select("k", "status", "place", "link"), upstream, override


#: Line items as sources of an order, numbered by priority.
SOURCES_SQL = """s AS (
    SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos,
           l_returnflag AS flag, l_linestatus AS line, CAST(l_shipdate AS DATE) AS ship, l_partkey AS part
    FROM lineitem)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = in_parts(table(spark, sf_dir, "lineitem"), "l_orderkey", rows=ITEMS).withColumn("pos", F.row_number().over(order).cast("bigint"))
    return rows.select(
        F.col("l_orderkey").alias("k"), "pos", F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line"), F.to_date("l_shipdate").alias("ship"), F.col("l_partkey").alias("part")
    )
