"""Time each scalable form next to the plain one it replaces.

    python tools/compare_forms.py [folder]
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starloom.operators.keys import assign_keys, first_per_group  # noqa: E402
from starloom.operators.nearest import Axis, nearest  # noqa: E402
from starloom.operators.quality import find_errors  # noqa: E402
from starloom.plans.queries.inputs import dirty_lineitem  # noqa: E402
from starloom.plans.queries.quality import _RULES  # noqa: E402
from starloom.plans.registry import table  # noqa: E402
from starloom.session import build_session  # noqa: E402


def nested_loop(left: DataFrame, refs: DataFrame, rx: float, ry: float) -> DataFrame:
    near = (F.abs(F.col("x") - F.col("rx")) < rx) & (F.abs(F.col("y") - F.col("ry")) < ry)
    d2 = (F.col("x") - F.col("rx")) ** 2 + (F.col("y") - F.col("ry")) ** 2
    pairs = left.join(F.broadcast(refs), near, "left").withColumn("d2", d2)
    return first_per_group(pairs, ["id"], ["d2", "rid"]).select("id", "name", "d2")


def main(folder: str) -> None:
    spark = build_session(
        "forms",
        master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="16g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    customer = table(spark, folder, "customer").selectExpr(
        "c_custkey as id", "c_acctbal as x", "double(c_nationkey) as y"
    )
    supplier = table(spark, folder, "supplier").selectExpr(
        "s_suppkey as rid", "s_name as name", "s_acctbal as rx", "double(s_nationkey) as ry"
    )
    places = customer.selectExpr("id", "x + 0.5 as x", "y")
    many = customer.selectExpr("id as rid", "string(id) as name", "x as rx", "y as ry")
    lines = dirty_lineitem(spark, folder)
    log = {"table_name": "lineitem", "now": F.lit("2025-07-04 12:00:00").cast("timestamp_ntz"), "identifier": "text"}
    x, y = Axis("x", "rx", 100.0), Axis("y", "ry", 3.0)
    forms = {
        "nearest of few: nested loop": lambda: nested_loop(customer, supplier, 100.0, 3.0),
        "nearest of few: cell lists": lambda: nearest(customer, supplier, x, y, label="name", tie="rid"),
        "nearest of many: nested loop": lambda: nested_loop(places, many, 1000.0, 5.0),
        "nearest of many: nested grids": lambda: nearest(
            places, many, Axis("x", "rx", 1000.0), Axis("y", "ry", 5.0), label="name", tie="rid"
        ),
        "surrogate keys: one partition": lambda: lines.withColumn(
            "sk", F.row_number().over(Window.orderBy("l_orderkey", "l_partkey", "l_suppkey"))
        ),
        "surrogate keys: range sort": lambda: assign_keys(lines, ["l_orderkey", "l_partkey", "l_suppkey"]),
        "error log: one plan per rule": lambda: reduce(
            DataFrame.unionByName, [find_errors(lines, [r], **log) for r in _RULES]
        ),
        "error log: shared scan": lambda: find_errors(lines, _RULES, **log),
    }
    for name, make in forms.items():
        spent = []
        for _ in range(3):
            begin = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - begin)
        print(f"{name:34s} {statistics.median(spent):7.2f} s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
