"""Key resolution, lookups, fact upserts, audits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom.functions.columns import concat_key, normalise_text
from starloom.operators.dates import date_dim
from starloom.operators.joins import Lookup, lookup_default, orphan_report, resolve_keys, star_join
from starloom.operators.keys import assign_keys
from starloom.operators.merge import apply_changes, changed_rows, upsert
from starloom.operators.predicates import where_since
from starloom.operators.versions import VersionLookup
from starloom.plans.queries.inputs import moment
from starloom.plans.registry import query, table


def _resolved(spark, sf):
    """Orders with calendar, priority and customer keys, all on computed keys."""
    orders = table(spark, sf, "orders")
    priorities = assign_keys(
        orders.select(F.upper("o_orderpriority").alias("priority")).distinct(), ["priority"]
    )
    customers = table(spark, sf, "customer").withColumn(
        "is_current", (F.col("c_acctbal") >= 0).cast("int")
    )
    return resolve_keys(
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
        [
            Lookup(
                date_dim(spark, full_date_type="timestamp_ntz"),
                [(F.col("o_orderdate").cast("date"), F.col("full_date").cast("date"))],
                {"date_key": "date_key"},
                current_only=False,
            ),
            Lookup(
                priorities,
                [(normalise_text("o_orderpriority"), normalise_text("priority"))],
                {"priority_key": "surrogate_key"},
                current_only=False,
            ),
            Lookup(
                customers,
                [
                    (
                        concat_key(F.lit("c"), "o_custkey"),
                        concat_key(F.lit("c"), "c_custkey"),
                    )
                ],
                {"customer_key": "c_custkey"},
            ),
        ],
    )


_RESOLVED = """
resolved AS (
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority,
           CASE WHEN o_orderdate >= TIMESTAMP '2010-01-01 00:00:00'
                THEN CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) END AS date_key,
           p.k AS priority_key, c.c_custkey AS customer_key
    FROM orders
    LEFT JOIN (SELECT TRIM(LOWER(o_orderpriority)) AS priority,
                      ROW_NUMBER() OVER (ORDER BY UPPER(o_orderpriority)) AS k
               FROM (SELECT DISTINCT o_orderpriority FROM orders)) p
      ON p.priority = TRIM(LOWER(o_orderpriority))
    LEFT JOIN customer c ON c.c_custkey = o_custkey AND c.c_acctbal >= 0
)"""


@query("resolve_keys", f"WITH {_RESOLVED} SELECT * FROM resolved")
def _(spark, sf):
    return _resolved(spark, sf)


def _versions(spark, sf):
    """Three versions per customer, at dates its number gives; some leave a gap."""
    base = table(spark, sf, "customer").withColumn(
        "first_day", F.expr("timestampadd(DAY, c_custkey % 900, timestamp_ntz'1994-06-01 00:00:00')")
    )
    second = F.expr("timestampadd(DAY, 200 + c_custkey % 700, first_day)")
    third = F.expr("timestampadd(HOUR, 17 * (c_custkey % 997) + 9, second)")
    pause = F.expr("timestampadd(DAY, 90 * cast(c_custkey % 5 = 0 as int), second)")
    dated = base.withColumns({"second": second}).withColumns({"third": third, "resumed": pause})
    number = F.col("c_custkey") * 10
    never = F.lit(None).cast("timestamp_ntz")
    spans = (
        (F.col("first_day"), F.col("second")),
        (F.least("resumed", "third"), F.col("third")),
        (F.col("third"), never),
    )
    rows = [
        F.struct((number + k).alias("version_key"), since.alias("since"), till.alias("till"))
        for k, (since, till) in enumerate(spans, 1)
    ]
    return dated.select(F.col("c_custkey").alias("member"), F.inline(F.array(*rows)))


@query(
    "resolve_versions",
    """
    WITH a AS (SELECT c_custkey, TIMESTAMP '1994-06-01 00:00:00' + to_days(CAST(c_custkey % 900 AS INTEGER)) AS d1
               FROM customer),
    b AS (SELECT *, d1 + to_days(CAST(200 + c_custkey % 700 AS INTEGER)) AS d2 FROM a),
    c AS (SELECT *, d2 + to_hours(CAST(17 * (c_custkey % 997) + 9 AS INTEGER)) AS d3 FROM b),
    v AS (SELECT c_custkey, c_custkey * 10 + 1 AS k, d1 AS since, d2 AS till FROM c
          UNION ALL
          SELECT c_custkey, c_custkey * 10 + 2,
                 least(CASE WHEN c_custkey % 5 = 0 THEN d2 + to_days(90) ELSE d2 END, d3), d3 FROM c
          UNION ALL SELECT c_custkey, c_custkey * 10 + 3, d3, NULL FROM c)
    SELECT o_orderkey, o_orderdate, v.k AS version_key,
           CASE WHEN o_orderdate < d1 THEN c.c_custkey * 10 + 1 ELSE v.k END AS earliest_key
    FROM orders LEFT JOIN c ON c.c_custkey = o_custkey
    LEFT JOIN v ON v.c_custkey = o_custkey AND since <= o_orderdate
               AND (till IS NULL OR o_orderdate < till)
    """,
)
def _(spark, sf):
    """Orders with the version of their customer that held on the day of the order."""
    versions = _versions(spark, sf)
    found = {
        name: VersionLookup(
            versions,
            [("o_custkey", "member")],
            {name: "version_key"},
            day="o_orderdate",
            start="since",
            end="till",
            early=early,
        )
        for name, early in (("version_key", "none"), ("earliest_key", "first"))
    }
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return resolve_keys(orders, list(found.values())).drop("o_custkey")


@query(
    "null_key_audit",
    f"""
    WITH {_RESOLVED}
    SELECT r.o_orderkey, r.o_custkey, c.c_nationkey, r.o_orderdate
    FROM resolved r JOIN customer c ON c.c_custkey = r.o_custkey
    WHERE r.customer_key IS NULL AND r.o_orderdate >= TIMESTAMP '1999-07-11 00:00:00'
    """,
)
def _(spark, sf):
    """Facts since a date without a dimension key, with what the dimension says."""
    since = where_since(_resolved(spark, sf), "o_orderdate", date(1999, 7, 11))
    return star_join(
        since.where("customer_key is null").select("o_orderkey", "o_custkey", "o_orderdate"),
        [
            Lookup(
                table(spark, sf, "customer"),
                [("o_custkey", "c_custkey")],
                {"c_nationkey": "c_nationkey"},
                current_only=False,
            )
        ],
    )


@query(
    "lookup_default",
    """
    SELECT o_orderkey, COALESCE(l_returnflag, 'Unknown') AS returnflag FROM orders
    LEFT JOIN (SELECT l_orderkey, l_returnflag, ROW_NUMBER() OVER (
                   PARTITION BY l_orderkey
                   ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag) AS rn
               FROM lineitem)
      ON l_orderkey = o_orderkey AND rn = 1
    """,
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return lookup_default(
        table(spark, sf, "orders").select("o_orderkey"),
        lines,
        "o_orderkey",
        "l_returnflag",
        "Unknown",
        order=["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"],
        out="returnflag",
    )


@query(
    "orphan_report",
    """
    SELECT 'o_custkey' AS foreign_key, CAST(o_custkey AS VARCHAR) AS "value", COUNT(*) AS rows
    FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    GROUP BY o_custkey
    """,
)
def _(spark, sf):
    reduced = table(spark, sf, "customer").where("c_acctbal >= 0")
    return orphan_report(table(spark, sf, "orders"), {"o_custkey": (reduced, "c_custkey")})


_FACT_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice"]


def _stored_and_load(spark, sf):
    """Orders before 1999 stored; a later load of 1997 on with corrections."""
    orders = table(spark, sf, "orders")
    stored = orders.where(F.col("o_orderdate") < moment("1999-01-01 00:00:00")).select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        "o_totalprice",
    )
    load = orders.where(F.col("o_orderdate") >= moment("1997-01-01 00:00:00")).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0.0))
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
    )
    return stored, load


def _upsert_sql(changed: str) -> str:
    take = f"(t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND {changed}))"
    cols = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in _FACT_COLUMNS)
    return f"""
    WITH t AS (
        SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_totalprice
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
    s AS (
        SELECT o_orderkey,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey,
               o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00')
    SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, {cols}
    FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
    """


_DISTINCT = "(" + " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in _FACT_COLUMNS) + ")"


@query("fact_upsert", _upsert_sql(_DISTINCT))
def _(spark, sf):
    return upsert(*_stored_and_load(spark, sf), ["o_orderkey"], _FACT_COLUMNS)


@query(
    "fact_upsert_parity",
    _upsert_sql(
        "COALESCE(" + " OR ".join(f"t.{c} <> s.{c}" for c in _FACT_COLUMNS) + ", FALSE)"
    ),
)
def _(spark, sf):
    return upsert(
        *_stored_and_load(spark, sf), ["o_orderkey"], _FACT_COLUMNS, null_safe=False
    )


_NULL_KEYS = """
    WITH o AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS k,
                      o_custkey AS c, o_orderstatus AS s, o_orderkey % 3 AS part FROM orders),
    t AS (SELECT k, c, s FROM o WHERE part <> 0), n AS (SELECT k, c, s FROM o WHERE part <> 1)
    SELECT * FROM t
    UNION ALL SELECT * FROM n WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM t WHERE k IS NOT NULL)
    UNION ALL """


def _null_keys(spark, sf, **options):
    rows = table(spark, sf, "orders").selectExpr(
        "if(o_orderkey % 7 = 0, null, o_orderkey) as k",
        "o_custkey as c",
        "o_orderstatus as s",
        "o_orderkey % 3 as part",
    )
    t, n = (rows.where(f"part <> {p}").drop("part") for p in (0, 1))
    once = upsert(t, n, ["k"], ["c", "s"], **options)
    return once if options else upsert(once, n, ["k"], ["c", "s"])


@query(
    "fact_upsert_null_keys",
    _NULL_KEYS + "(SELECT * FROM n WHERE k IS NULL EXCEPT ALL SELECT * FROM t WHERE k IS NULL)",
)
def _(spark, sf):
    """The same load twice; rows without a key are added once."""
    return _null_keys(spark, sf)


@query("fact_upsert_null_keys_parity", _NULL_KEYS + "SELECT * FROM n WHERE k IS NULL")
def _(spark, sf):
    """Rows without a key are added whatever is stored."""
    return _null_keys(spark, sf, null_keys="append")


@query(
    "fact_changes",
    _upsert_sql(_DISTINCT).split("SELECT COALESCE(t.")[0]
    + f"""
    SELECT s.*, t.o_orderstatus AS _was_o_orderstatus FROM s LEFT JOIN t USING (o_orderkey)
    WHERE t.o_orderkey IS NULL OR {_DISTINCT}
    """,
)
def _(spark, sf):
    return changed_rows(
        *_stored_and_load(spark, sf), ["o_orderkey"], _FACT_COLUMNS, was=["o_orderstatus"]
    )


@query("fact_apply_changes", _upsert_sql(_DISTINCT))
def _(spark, sf):
    stored, load = _stored_and_load(spark, sf)
    changes = changed_rows(stored, load, ["o_orderkey"], _FACT_COLUMNS)
    return apply_changes(stored, changes, ["o_orderkey"])
