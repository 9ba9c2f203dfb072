"""Star reports and the curated model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom.operators.dates import date_dim
from starloom.operators.joins import Lookup, star_join
from starloom.operators.profile import count_by
from starloom.operators.star import ModelDim, StarModel, label_report, star_report
from starloom.plans.registry import query, table


def calendar(spark):
    return date_dim(spark, start=date(1990, 1, 1), full_date_type="date")


def _by_day(spark, col, take):
    return Lookup(
        calendar(spark),
        [(F.col(col).cast("date"), "full_date")],
        {t: t for t in take},
        current_only=False,
    )


@query(
    "star_report_month",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, monthname(o_orderdate) AS month_name,
           c_mktsegment AS segment, COUNT(*) AS orders
    FROM orders JOIN customer ON c_custkey = o_custkey
    GROUP BY 1, 2, 3 ORDER BY orders DESC, year, month_name, segment
    """,
)
def star_report_month(spark, sf):
    """Orders by year, month and customer segment."""
    return star_report(
        table(spark, sf, "orders").select("o_orderdate", "o_custkey"),
        [_by_day(spark, "o_orderdate", ["year", "month_name"])],
        ["year", "month_name", "segment"],
        large=[
            Lookup(
                table(spark, sf, "customer"),
                [("o_custkey", "c_custkey")],
                {"segment": "c_mktsegment"},
                current_only=False,
            )
        ],
        name="orders",
        order=True,
    )


@query(
    "star_report_year",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, p_type AS part_category,
           s_nationkey AS supplier_nation, COUNT(*) AS rows
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE p_retailprice < 1500 GROUP BY 1, 2, 3
    """,
)
def _(spark, sf):
    """Line items by year and two dimensions, current members only."""
    parts = table(spark, sf, "part").withColumn(
        "is_current", (F.col("p_retailprice") < 1500).cast("int")
    )
    return star_report(
        table(spark, sf, "lineitem").select("l_shipdate", "l_partkey", "l_suppkey"),
        [_by_day(spark, "l_shipdate", ["year"])],
        ["year", "part_category", "supplier_nation"],
        large=[
            Lookup(parts, [("l_partkey", "p_partkey")], {"part_category": "p_type"}),
            Lookup(
                table(spark, sf, "supplier"),
                [("l_suppkey", "s_suppkey")],
                {"supplier_nation": "s_nationkey"},
                current_only=False,
            ),
        ],
    )


@query(
    "star_join",
    """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
           c_mktsegment AS segment
    FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
    """,
)
def _(spark, sf):
    customers = table(spark, sf, "customer").withColumn(
        "is_current", (F.col("c_acctbal") >= 0).cast("int")
    )
    return star_join(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey"),
        [
            _by_day(spark, "o_orderdate", ["date_key"]),
            Lookup(customers, [("o_custkey", "c_custkey")], {"segment": "c_mktsegment"}),
        ],
    ).select("o_orderkey", "date_key", "segment")


@query(
    "star_report_fanout",
    """
    SELECT c_nationkey, COUNT(*) AS rows
    FROM customer JOIN supplier ON s_nationkey = c_nationkey GROUP BY c_nationkey
    """,
)
def _(spark, sf):
    return label_report(
        table(spark, sf, "customer"), table(spark, sf, "supplier"), "c_nationkey", "s_nationkey"
    )


@query(
    "label_counts",
    "SELECT c_nationkey, COUNT(*) AS rows FROM customer GROUP BY 1 ORDER BY rows DESC, 1",
)
def _(spark, sf):
    return count_by(table(spark, sf, "customer"), ["c_nationkey"], name="rows", order="count")


@query(
    "calendar_report",
    """
    SELECT CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
           CASE WHEN month(d) BETWEEN 7 AND 9 THEN 1 WHEN month(d) >= 10 THEN 2
                WHEN month(d) <= 3 THEN 3 ELSE 4 END AS fiscal_quarter,
           CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, COUNT(*) AS rows
    FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY ALL
    """,
)
def _(spark, sf):
    by = ["fiscal_year", "fiscal_quarter", "is_weekend"]
    return star_report(
        table(spark, sf, "lineitem").select("l_shipdate"),
        [_by_day(spark, "l_shipdate", by)],
        by,
    )


def _model(spark, sf):
    fact = table(spark, sf, "lineitem").withColumn("date_key", F.col("l_shipdate").cast("date"))
    return StarModel(
        fact=fact.select(
            "l_partkey", "l_suppkey", "date_key", "l_quantity", "l_extendedprice"
        ),
        dims={
            "date": ModelDim(
                calendar(spark),
                "date_key",
                "full_date",
                {"Year": "year", "Month_name": "month_name"},
            ),
            "part": ModelDim(
                table(spark, sf, "part"),
                "l_partkey",
                "p_partkey",
                {"Type": "p_type", "Brand": "p_brand", "Size": "p_size"},
                frozenset({"Size"}),
            ),
            "supplier": ModelDim(
                table(spark, sf, "supplier"),
                "l_suppkey",
                "s_suppkey",
                {"Nation": "s_nationkey"},
            ),
        },
        measures={"quantity": "l_quantity", "price": "l_extendedprice"},
    )


@query(
    "model_measures",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS "Year", p_type AS "Type",
           SUM(l_quantity) AS quantity, ROUND(SUM(l_extendedprice), 2) AS price
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
    """,
)
def _(spark, sf):
    return _model(spark, sf).report(["Year", "Type"]).withColumn("price", F.round("price", 2))


@query(
    "model_frame",
    """
    SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS date_key, l_quantity,
           l_extendedprice, p_type AS "Type", p_brand AS "Brand", s_nationkey AS "Nation"
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    """,
)
def _(spark, sf):
    return _model(spark, sf).frame(["part", "supplier"])
