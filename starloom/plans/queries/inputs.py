"""Inputs the queries share: the given tables with missing values put in.

The given tables hold no nulls.  Values are blanked by a rule on the value
itself, stated once here for Spark and once as a CTE for the SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.registry import table


def moment(text: str) -> Column:
    """A zone-less timestamp constant, so results never depend on the session."""
    return F.lit(text).cast("timestamp_ntz")


def dirty_customer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        F.nullif("c_nationkey", F.lit(7)).alias("c_nationkey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )


DIRTY_CUSTOMER = """
dirty AS (
    SELECT c_custkey, c_name, NULLIF(c_nationkey, 7) AS c_nationkey,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
           NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment
    FROM customer
)"""


def dirty_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.nullif("l_quantity", F.lit(50.0)).alias("l_quantity"),
        "l_discount",
        "l_tax",
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.nullif("l_linestatus", F.lit("F")).alias("l_linestatus"),
        "l_shipdate",
    )


DIRTY_LINEITEM = """
dirty AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           NULLIF(l_quantity, 50.0) AS l_quantity, l_discount, l_tax,
           NULLIF(l_returnflag, 'R') AS l_returnflag,
           NULLIF(l_linestatus, 'F') AS l_linestatus, l_shipdate
    FROM lineitem
)"""
