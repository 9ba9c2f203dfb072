"""Round trips through files, tables and marks: what was written is read back.

Each query works on tables of its own in the warehouse and drops their entries
again; what it returns is stored as an intermediate table before that.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import Lookup, resolve_keys
from starloom.operators.late import INFERRED, adopt_members, infer_members, load_or_wait
from starloom.operators.profile import row_count
from starloom.plans.queries.inputs import moment
from starloom.plans.registry import query, table
from starloom.session import reliable_checkpoint, shared_folder
from starloom.sources.layout import clustered, compact
from starloom.sources.readers import read_json, records_to_df
from starloom.sources.run_log import RunLog
from starloom.sources.sinks import (
    append,
    ctas_if_absent,
    ensure_table,
    insert_into,
    register_view,
    replace_partitions,
    replace_table,
    vacuum,
)
from starloom.streaming.incremental import incremental_load

_NATION = "n_nationkey int, n_name string, n_regionkey int"


@contextmanager
def _own_tables(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """Table names nobody else has; the tables go at the end."""
    own = [f"starloom_{n}_{uuid4().hex}" for n in names]
    try:
        yield own
    finally:
        for name in own:
            if spark.catalog.tableExists(name):
                # Emptied first: dropping an external table leaves its files.
                replace_table(spark.table(name).limit(0), name)
                vacuum(spark, name)
                spark.sql(f"DROP TABLE {name}")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )


@query(
    "json_round_trip",
    """
    SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name,
           CAST(n_regionkey AS INTEGER) AS n_regionkey, CAST(NULL AS VARCHAR) AS missing, way
    FROM nation, (VALUES ('file'), ('records')) AS w(way)
    """,
)
def _(spark, sf):
    """Landed JSON under an explicit schema; a field no record has is NULL."""
    folder = f"{shared_folder(spark)}/starloom-json-{uuid4().hex}"
    table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").write.json(folder)
    schema = _NATION + ", missing string"
    lines = records_to_df(spark, folder, schema).withColumn("way", F.lit("records"))
    plain = read_json(spark, folder, schema, multiline=False).withColumn("way", F.lit("file"))
    return lines.unionByName(plain)


@query(
    "json_multiline",
    """
    SELECT CAST(r_regionkey AS INTEGER) AS region, r_name AS name, n_name AS nation, note
    FROM region JOIN nation ON n_regionkey = r_regionkey
    LEFT JOIN (VALUES (0, 'first'), (2, NULL), (9, 'nowhere')) AS t(k, note) ON k = r_regionkey
    """,
)
def _(spark, sf):
    """A document per region over several lines, read whole; literal rows beside it."""
    folder = f"{shared_folder(spark)}/starloom-json-{uuid4().hex}"
    nation = table(spark, sf, "nation")
    documents = (
        table(spark, sf, "region")
        .join(nation, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_regionkey").cast("int").alias("region"), F.col("r_name").alias("name"))
        .agg(F.collect_list(F.struct(F.col("n_name").alias("nation"))).alias("nations"))
    )
    text = F.replace(F.to_json(F.struct("*"), {"pretty": "true"}), F.lit("\r"), F.lit(""))
    # A file holds one document, so each is a partition of its own.
    documents.select("region", text.alias("value")).write.partitionBy("region").text(folder)
    schema = "region int, name string, nations array<struct<nation string>>"
    read = read_json(spark, f"{folder}/*", schema, multiline=True)
    notes = records_to_df(spark, [(0, "first"), (2, None), (9, "nowhere")], "region int, note string")
    flat = read.select("region", "name", F.inline("nations"))
    return flat.join(notes, "region", "left").select("region", "name", "nation", "note")


@query(
    "table_round_trip",
    """
    SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders
    WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, -o_totalprice, o_orderpriority, o_orderstatus FROM orders
    WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT -o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders
    WHERE o_orderstatus = 'O'
    """,
)
def _(spark, sf):
    """A partitioned table made, replaced by itself, in one partition, and added to."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    with _own_tables(spark, "orders") as (name,):
        ensure_table(spark, name, orders.schema, ["o_orderstatus"])
        append(orders.limit(0), name)
        replace_table(orders, name, ["o_orderstatus"])
        replace_table(spark.table(name), name, ["o_orderstatus"])
        pending = spark.table(name).where("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
        replace_partitions(pending.withColumn("o_totalprice", -F.col("o_totalprice")), name)
        insert_into(
            orders.where("o_orderstatus = 'O'").withColumn("o_orderkey", -F.col("o_orderkey")), name
        )
        vacuum(spark, name)
        return reliable_checkpoint(spark.table(name).select(*orders.columns))


@query(
    "ctas_and_view",
    """
    SELECT s_nationkey, SUM(s_acctbal) AS balance, MAX(n) AS suppliers
    FROM supplier, (SELECT COUNT(*) AS n FROM supplier) GROUP BY s_nationkey
    """,
)
def _(spark, sf):
    """A table made once: the second attempt, with other rows, changes nothing."""
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    view = f"starloom_supplier_{uuid4().hex}"
    with _own_tables(spark, "supplier") as (name,):
        made = ctas_if_absent(supplier, name)
        again = ctas_if_absent(supplier.limit(0), name)
        if not made or again:
            raise RuntimeError("a table is made exactly once")
        register_view(spark.table(name), view)
        n = row_count(spark.table(name))
        out = spark.sql(
            f"SELECT s_nationkey, SUM(s_acctbal) AS balance FROM {view} GROUP BY s_nationkey"
        ).withColumn("suppliers", F.lit(n).cast("bigint"))
        out = reliable_checkpoint(out)
        spark.catalog.dropTempView(view)
        return out


@query(
    "incremental_load_twice",
    """
    SELECT event_id, event_type, value,
           CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' AND event_id % 7 <> 0
                THEN TIMESTAMP '2024-03-01 00:00:00'
                ELSE TIMESTAMP '2024-03-02 00:00:00' END AS loaded_at
    FROM events
    """,
)
def _(spark, sf):
    """Two loads and one with nothing new; the second brings late records as well.

    The first has what is published by the middle of January, but for some late
    records. The second looks back over all of it and skips what is held.
    """
    events = _events(spark, sf)
    known = events.where((F.col("ts") <= moment("2024-01-15 00:00:00")) & (F.col("event_id") % 7 != 0))
    with _own_tables(spark, "bronze", "marks") as (bronze, marks):

        def load(source, day, **options):
            return incremental_load(
                source,
                bronze,
                marks,
                mark_col="ts",
                columns=events.columns,
                batch_ts=datetime(2024, 3, day),
                default=datetime(1970, 1, 1),
                key=["event_id"],
                **options,
            )

        loads = [load(known, 1), load(events, 2, lookback=timedelta(days=36_500)), load(events, 3)]
        if loads[1:] != [True, False]:
            raise RuntimeError("the second load has rows, the third none")
        return reliable_checkpoint(
            spark.table(bronze).select(
                "event_id",
                "event_type",
                "value",
                F.col("extraction_timestamp").cast("timestamp_ntz").alias("loaded_at"),
            )
        )


@query(
    "late_members_wait",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN c_custkey % 21 <> 0 THEN c_custkey * 2 END AS customer_key,
           CASE WHEN c_custkey % 21 <> 0 THEN 'fact' ELSE 'waiting' END AS place,
           CASE WHEN o_orderkey % 10 = 0 AND NOT (c_custkey % 3 <> 0 AND o_orderkey % 2 = 0)
                THEN 'corrected' ELSE o_orderstatus END AS status
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def _(spark, sf):
    """Orders loaded while a third of the customers is not there yet, then the rest.

    The second load corrects some orders: those that waited take it, those that
    were loaded are not added twice. Customers that never come keep theirs waiting.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    known = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") * 2).alias("key"), F.lit(1).alias("is_current"))
    corrected = F.when(F.col("o_orderkey") % 10 == 0, "corrected").otherwise(F.col("status"))
    with _own_tables(spark, "fact", "waiting") as (fact, waiting):

        def load(part, customers):
            look = Lookup(customers, [("o_custkey", "c_custkey")], {"customer_key": "key"})
            return load_or_wait(part, [look], fact, waiting, ["o_orderkey"])

        some, most = known.where("c_custkey % 3 <> 0"), known.where("c_custkey % 21 <> 0")
        even = orders.where("o_orderkey % 2 = 0")
        load(even, some)
        load(orders.withColumn("status", corrected), some)
        load(orders.limit(0), most)
        left = load(even.limit(0), most)
        kept = spark.table(waiting).withColumns({"customer_key": F.lit(None).cast("bigint"), "place": F.lit("waiting")})
        if left != kept.count():
            raise RuntimeError("what waits is counted")
        return reliable_checkpoint(spark.table(fact).withColumn("place", F.lit("fact")).unionByName(kept))


@query(
    "late_members_inferred",
    """
    WITH named AS (SELECT DISTINCT o_custkey FROM orders),
    late AS (SELECT o_custkey AS k, row_number() OVER (ORDER BY o_custkey) AS rn FROM named WHERE o_custkey % 3 = 0)
    SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey
                            ELSE rn + (SELECT max(c_custkey) FROM customer WHERE c_custkey % 3 <> 0) END AS surrogate_key,
           CASE WHEN o_custkey % 21 = 0 THEN 'Unknown' ELSE c_mktsegment END AS segment,
           CASE WHEN o_custkey % 21 = 0 THEN 1 ELSE 0 END AS is_inferred
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN late ON k = o_custkey
    """,
)
def _(spark, sf):
    """Orders point at stand-ins for customers still to come; these take them over."""
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("member"), F.col("c_mktsegment").alias("segment"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    dim = customer.where("member % 3 <> 0").select(
        F.col("member").alias("surrogate_key"),
        "member",
        "segment",
        F.lit(datetime(2024, 1, 1)).alias("effective_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
        F.lit(1).alias("is_current"),
        F.lit(0).alias(INFERRED),
    )
    dim = infer_members(dim, orders, "o_custkey", "member", datetime(2024, 2, 1), {"segment": "Unknown"})
    fact = resolve_keys(orders, [Lookup(dim, [("o_custkey", "member")], {"surrogate_key": "surrogate_key"})])
    fact = reliable_checkpoint(fact.select("o_orderkey", "surrogate_key"))
    dim = adopt_members(dim, customer.where("member % 21 <> 0"), "member", ["segment"])
    return fact.join(dim.select("surrogate_key", "segment", INFERRED), "surrogate_key")


@query(
    "clustered_compacted",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, l_returnflag,
           n AS rows_logged FROM lineitem, (SELECT count(*) AS n FROM lineitem)
    """,
)
def _(spark, sf):
    """Line items written clustered by part and day, appended to, and compacted; the
    count is the one that the write logged."""
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"]
    items = table(spark, sf, "lineitem").select(*names)
    with _own_tables(spark, "items", "log") as (name, log):
        runs = RunLog(spark, log, "load")
        late = F.col("l_orderkey") % 7 == 0
        first = clustered(items.where(~late), ["l_partkey", "l_shipdate"], 8)
        runs.write("first", first, lambda df: replace_table(df, name, ["l_returnflag"]))
        for k in range(3):
            part = items.where(late & (F.col("l_partkey") % 3 == k)).repartition(4)
            runs.write(f"late {k}", part, lambda df: append(df, name))
        before, after = compact(spark, name)
        if after >= before:
            raise RuntimeError("compaction leaves fewer files")
        logged = runs.rows().where("status = 'done'").agg(F.sum("rows")).first()[0]
        return reliable_checkpoint(spark.table(name).select(*names).withColumn("rows_logged", F.lit(logged).cast("bigint")))
