"""The whole crash warehouse, run on records made from the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import fields, replace
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.changes import run_changes
from starloom.plans.crashes import BRONZE_SCHEMA, CrashWarehouse
from starloom.plans.registry import query, table
from starloom.plans.warehouse import run_pipeline
from starloom.session import reliable_checkpoint
from starloom.sources.sinks import replace_table, vacuum

_INPUTS = {
    *("boroughs", "vehicle_spellings", "factor_categories", "rules", "calendar", "parity"),
    *("fact_versions", "typing_errors", "borough_areas", "area_cell", "runs"),
}


@contextmanager
def own_warehouse(spark: SparkSession, **options) -> Iterator[CrashWarehouse]:
    """A warehouse with tables nobody else has; they go at the end."""
    points = spark.createDataFrame([("West", 20.0, 10.0)], "borough string, longitude double, latitude double")
    vehicles = {"Passenger Vehicles": ["sedan"], "Public Transit": ["bus"]}
    cfg = CrashWarehouse(boroughs=points, vehicle_spellings=vehicles, **options)
    run = uuid4().hex
    names = {f.name: f"starloom_{f.name}_{run}" for f in fields(cfg) if f.name not in _INPUTS}
    try:
        yield replace(cfg, **names)
    finally:
        for name in names.values():
            if spark.catalog.tableExists(name):
                # Emptied first: dropping an external table leaves its files.
                replace_table(spark.table(name).limit(0), name)
                vacuum(spark, name)
                spark.sql(f"DROP TABLE {name}")


def crash_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as crash records of one year; ``part`` says when one is published.

    The third part corrects some of the others: a day a year later and another
    number of injured.
    """
    orders = table(spark, sf, "orders").where("o_orderkey is not null")
    place = F.concat(F.lit("10.00"), (F.col("o_custkey") % 10).cast("string"))
    factors = {"1-URGENT": "Unsafe Speed", "2-HIGH": "GLARE", "3-MEDIUM": "Brakes Defective", "5-LOW": "Something Else"}
    factor = F.lit(None).cast("string")
    for priority, name in factors.items():
        factor = F.when(F.col("o_orderpriority") == priority, name).otherwise(factor)
    corrected = (F.col("o_orderkey") % 13 == 0).cast("int")
    parts = orders.select(
        "*", F.explode(F.when(corrected == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again")
    )
    weeks = F.floor(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) / 7).cast("int")
    day = F.date_add(F.lit("2025-01-01").cast("date"), weeks + F.when(F.col("again") == 1, 366).otherwise(0))
    number = F.col("o_orderkey") % 4
    record = {
        "collision_id": F.col("o_orderkey").cast("string"),
        "crash_date": F.concat(day.cast("string"), F.lit("T00:00:00.000")),
        "crash_time": F.lit("9:05"),
        "borough": F.when(
            F.col("o_orderkey") % 5 > 0, F.element_at(F.array(*map(F.lit, ("NORTH", "SOUTH", "EAST"))), (F.col("o_custkey") % 3 + 1).cast("int"))
        ),
        "latitude": F.when(F.col("o_orderkey") % 41 > 0, place),
        "longitude": F.lit("20.0"),
        "number_of_persons_injured": F.when(F.col("again") == 1, "9")
        .when(F.col("o_orderkey") % 50 == 0, "x")
        .otherwise(number.cast("string")),
        "number_of_persons_killed": F.lit("0"),
        "contributing_factor_vehicle_1": factor,
        "vehicle_type_code1": F.when(F.col("o_orderstatus") == "F", "sedan").when(F.col("o_orderstatus") == "O", " BUS"),
    }
    part = F.when(F.col("again") == 1, 3).when(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"), 1).otherwise(2)
    return parts.select(*[c.alias(n) for n, c in record.items()], part.alias("part"))


def _facts(spark: SparkSession, cfg: CrashWarehouse) -> DataFrame:
    """Facts with what their keys stand for."""

    def dim(name: str, key: str, **take: str) -> DataFrame:
        return spark.table(name).select(F.col("surrogate_key").alias(key), *[F.col(c).alias(n) for n, c in take.items()])

    out = spark.table(cfg.fact)
    out = out.join(dim(cfg.dim_factor, "factor_key", factor_category="category"), "factor_key", "left")
    out = out.join(dim(cfg.dim_vehicle, "vehicle_key", vehicle_category="category"), "vehicle_key", "left")
    out = out.join(dim(cfg.dim_location, "location_key", place="borough"), "location_key", "left")
    return out.select(
        F.col("collision_id").cast("bigint").alias("collision_id"),
        "date_key",
        "year",
        "number_of_persons_injured",
        "factor_category",
        "vehicle_category",
        "place",
    )


_RECORDS = """
record AS (
    SELECT o_orderkey, o_custkey, o_orderkey % 13 = 0 AS corrected,
           date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 7 AS week,
           CASE WHEN o_orderkey % 41 > 0 THEN o_custkey % 10 END AS spot,
           CASE WHEN o_orderkey % 5 = 0 THEN 'West' WHEN o_custkey % 3 = 0 THEN 'North'
                WHEN o_custkey % 3 = 1 THEN 'South' ELSE 'East' END AS borough,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Driver Behavior' WHEN '2-HIGH' THEN 'Environmental Factors'
                WHEN '3-MEDIUM' THEN 'Vehicle Issues' WHEN '5-LOW' THEN 'Uncategorized'
                ELSE 'Other/Unspecified' END AS factor_category,
           CASE o_orderstatus WHEN 'F' THEN 'Passenger Vehicles' WHEN 'O' THEN 'Public Transit'
                ELSE 'Uncategorized' END AS vehicle_category,
           o_orderpriority = '4-NOT SPECIFIED' AS no_factor, o_orderstatus = 'P' AS no_vehicle
    FROM orders),
dated AS (
    SELECT *, DATE '2025-01-01' + CAST(week + CASE WHEN corrected THEN 366 ELSE 0 END AS INTEGER) AS day
    FROM record),
places AS (SELECT spot, min(borough) AS place FROM dated WHERE spot IS NOT NULL GROUP BY spot),
facts AS (
    SELECT o_orderkey AS collision_id, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key,
           CAST(year(day) AS INTEGER) AS year,
           CAST(CASE WHEN corrected THEN 9 WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey % 4 END AS INTEGER)
               AS number_of_persons_injured,
           factor_category, vehicle_category, place
    FROM dated JOIN places USING (spot))"""


def _run(spark: SparkSession, sf: str, run: Callable, cfg: CrashWarehouse, loads: tuple[int, ...]) -> None:
    records = reliable_checkpoint(crash_records(spark, sf))
    columns = [c.split()[0] for c in BRONZE_SCHEMA.split(", ")]
    for k, upto in enumerate(loads):
        run(records.where(F.col("part") <= upto).select(*columns), cfg, datetime(2026, 5, 1 + k, 6))


@query("warehouse_run", f"WITH {_RECORDS} SELECT * FROM facts")
def _(spark, sf):
    """Extract to fact in two full runs, corrections being in the second."""
    with own_warehouse(spark) as cfg:
        _run(spark, sf, run_pipeline, cfg, (2, 3))
        return reliable_checkpoint(_facts(spark, cfg))


@query(
    "warehouse_changes",
    f"""
    WITH {_RECORDS},
    published AS (
        SELECT * FROM record UNION ALL SELECT * FROM record WHERE corrected),
    errors AS (
        SELECT 'Null_check' AS error_type, 'log$lat' AS columns_checked FROM published WHERE spot IS NULL
        UNION ALL SELECT 'Null_check', 'borough' FROM published WHERE o_orderkey % 5 = 0
        UNION ALL SELECT 'Null_check', 'Factor' FROM published WHERE no_factor
        UNION ALL SELECT 'Null_check', 'Vehicle_type' FROM published WHERE no_vehicle)
    SELECT *, NULL AS error_type, NULL AS columns_checked, NULL AS errors FROM facts
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, error_type, columns_checked, count(*) FROM errors GROUP BY ALL
    """,
)
def _(spark, sf):
    """The same facts by a first run and two that follow new batches alone, and the
    errors of all, summed from the merged roll-up."""
    with own_warehouse(spark) as cfg:
        _run(spark, sf, run_changes, cfg, (1, 2, 3))
        errors = spark.table(cfg.log_counts).groupBy("error_type", "columns_checked").agg(F.sum("count").alias("errors"))
        return reliable_checkpoint(_facts(spark, cfg).unionByName(errors, allowMissingColumns=True))
