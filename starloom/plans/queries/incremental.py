"""Incremental reads and high-water marks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starloom.functions.columns import month_start
from starloom.operators.ordering import union_all
from starloom.operators.profile import count_by
from starloom.plans.queries.inputs import moment
from starloom.plans.registry import query, table
from starloom.sources.readers import incremental_read, stamp_batch
from starloom.streaming.marks import next_mark, seed_mark, upsert_mark

LAST = datetime(2024, 1, 15)


@query(
    "incremental_read",
    """
    SELECT event_id, ts, event_type, value,
           '2024-02-01T06:00:00' AS extraction_timestamp
    FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
    """,
)
def _(spark, sf):
    new = incremental_read(
        table(spark, sf, "events"), "ts", LAST, ["event_id", "ts", "event_type", "value"]
    )
    return stamp_batch(new, datetime(2024, 2, 1, 6))


def _marks(events):
    """One mark per event type, at midnight of its last day."""
    return events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.max("ts").cast("date").cast("timestamp_ntz").alias("last_watermark")
    )


@query(
    "high_water_mark",
    """
    SELECT event_type AS table_name,
           CAST(CAST(MAX(ts) AS DATE) AS TIMESTAMP) AS seeded,
           MAX(ts) AS next_mark
    FROM events GROUP BY event_type
    """,
)
def _(spark, sf):
    """Each kind of event as a source of its own, all in one pass per mark."""
    events, at, kind = table(spark, sf, "events"), datetime(2024, 2, 1), F.col("event_type")
    seeded, top = (
        mark(events, "ts", kind, at).select(
            "table_name", F.col("last_watermark").cast("timestamp_ntz").alias(name)
        )
        for mark, name in ((seed_mark, "seeded"), (next_mark, "next_mark"))
    )
    return seeded.join(top, "table_name")


@query(
    "mark_upsert",
    """
    SELECT event_type AS table_name,
           CASE WHEN event_type = 'click' THEN MAX(ts)
                ELSE CAST(CAST(MAX(ts) AS DATE) AS TIMESTAMP) END AS last_watermark
    FROM events GROUP BY event_type
    """,
)
def _(spark, sf):
    events = table(spark, sf, "events")
    new = (
        events.where("event_type = 'click'")
        .agg(F.max("ts").alias("last_watermark"))
        .select(F.lit("click").alias("table_name"), "last_watermark")
    )
    return upsert_mark(_marks(events), new)


@query(
    "batch_counts",
    "SELECT CAST(ts AS DATE) AS day, COUNT(*) AS rows FROM events GROUP BY 1 ORDER BY 1",
)
def _(spark, sf):
    day = F.col("ts").cast("date").alias("day")
    return count_by(table(spark, sf, "events"), [day], name="rows", order="keys")


@query(
    "month_partition",
    """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, COUNT(*) AS rows
    FROM orders GROUP BY 1
    """,
)
def _(spark, sf):
    month = month_start("o_orderdate").alias("order_month")
    return count_by(table(spark, sf, "orders"), [month], name="rows")


@query(
    "union_all",
    """
    SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL
    SELECT s_name, s_nationkey, s_acctbal FROM supplier
    """,
)
def _(spark, sf):
    sides = [
        table(spark, sf, t).select(
            F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nationkey"),
            F.col(f"{p}_acctbal").alias("acctbal"),
        )
        for t, p in (("customer", "c"), ("supplier", "s"))
    ]
    return union_all(*sides)


@query(
    "stamp_types",
    """
    SELECT event_type, TIMESTAMP '2024-02-01 06:00:00' AS loaded_at, COUNT(*) AS rows
    FROM events GROUP BY event_type
    """,
)
def _(spark, sf):
    return count_by(
        table(spark, sf, "events").withColumn("loaded_at", moment("2024-02-01 06:00:00")),
        ["event_type", "loaded_at"],
        name="rows",
    )
