"""Projections, predicates, casts, fills, sorting."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom.functions.columns import clock_text, iso_date, normalise_text
from starloom.operators.categorize import categorize
from starloom.operators.fuzzy import fuzzy_categorize
from starloom.operators.columns import (
    annotate,
    cast_failures,
    cast_schema,
    coalesce_into,
    fill,
    normalize_case,
    project,
)
from starloom.operators.ordering import head_n, order
from starloom.operators.predicates import (
    drop_nulls,
    drop_values,
    where_not_null,
    where_null,
    where_since,
    where_value,
)
from starloom.operators.profile import count_by, distinct_by
from starloom.plans.queries.inputs import (
    DIRTY_CUSTOMER,
    DIRTY_LINEITEM,
    dirty_customer,
    dirty_lineitem,
)
from starloom.plans.registry import query, table


@query(
    "project_rename",
    "SELECT c_custkey AS customer_id, c_name, c_mktsegment AS segment, 'crm' AS origin FROM customer",
)
def _(spark, sf):
    kept = project(
        table(spark, sf, "customer"),
        drop=["c_nationkey", "c_acctbal"],
        rename={"c_custkey": "customer_id", "c_mktsegment": "segment"},
    )
    return annotate(kept, {"origin": "crm"})


def _event_texts(spark, sf):
    """Events as text, as a loosely typed source would hand them over."""
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
        .alias("value"),
        F.when(F.col("event_type") == "view", F.lit("yesterday"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("day"),
        F.when(F.col("event_type") == "click", F.lit("25:70"))
        .otherwise(F.concat_ws(":", F.hour(ts).cast("string"), F.date_format(ts, "mm")))
        .alias("clock"),
        F.when(F.col("event_type") == "signup", F.lit(""))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
    )


_EVENT_CASTS = {"value": "double", "day": iso_date, "clock": clock_text, "user_id": "int"}


@query(
    "cast_schema",
    """
    SELECT event_id,
           CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS day,
           CASE WHEN event_type <> 'click' THEN strftime(ts, '%H:%M') || ':00' END AS clock,
           CASE WHEN event_type <> 'signup' THEN CAST(user_id AS INTEGER) END AS user_id
    FROM events
    """,
)
def _(spark, sf):
    return cast_schema(_event_texts(spark, sf), _EVENT_CASTS)


@query("cast_failures", "SELECT event_id FROM events WHERE event_type <> 'purchase'")
def _(spark, sf):
    return cast_failures(_event_texts(spark, sf), _EVENT_CASTS).select("event_id")


@query(
    "where_null_all",
    f"WITH {DIRTY_CUSTOMER} SELECT * FROM dirty WHERE c_nationkey IS NULL AND c_acctbal IS NULL",
)
def _(spark, sf):
    return where_null(dirty_customer(spark, sf), ["c_nationkey", "c_acctbal"])


@query(
    "any_null_rows",
    f"""
    WITH {DIRTY_CUSTOMER} SELECT * FROM dirty
    WHERE c_custkey IS NULL OR c_name IS NULL OR c_nationkey IS NULL
       OR c_acctbal IS NULL OR c_mktsegment IS NULL
    """,
)
def _(spark, sf):
    df = dirty_customer(spark, sf)
    return where_null(df, df.columns, how="any")


@query(
    "where_not_null",
    f"""
    WITH {DIRTY_CUSTOMER} SELECT c_custkey, c_mktsegment, c_acctbal FROM dirty
    WHERE c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL
    """,
)
def _(spark, sf):
    return where_not_null(dirty_customer(spark, sf), ["c_mktsegment", "c_acctbal"]).select(
        "c_custkey", "c_mktsegment", "c_acctbal"
    )


@query(
    "drop_nulls",
    f"""
    WITH {DIRTY_CUSTOMER} SELECT * FROM dirty
    WHERE c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL
    """,
)
def _(spark, sf):
    return drop_nulls(dirty_customer(spark, sf), ["c_nationkey", "c_acctbal"])


@query(
    "zero_sentinel",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_discount = 0 AND l_tax = 0
    """,
)
def _(spark, sf):
    return where_value(table(spark, sf, "lineitem"), {"l_discount": 0.0, "l_tax": 0.0}).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    "drop_values",
    """
    SELECT l_returnflag, COUNT(*) AS rows FROM lineitem
    WHERE l_discount <> 0 AND l_tax <> 0 GROUP BY l_returnflag
    """,
)
def _(spark, sf):
    kept = drop_values(table(spark, sf, "lineitem"), ["l_discount", "l_tax"], 0.0)
    return count_by(kept, ["l_returnflag"], name="rows")


@query(
    "where_since",
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2000-07-11'
    """,
)
def _(spark, sf):
    return where_since(table(spark, sf, "orders"), "o_orderdate", date(2000, 7, 11)).select(
        "o_orderkey", "o_orderdate"
    )


@query(
    "fill_unknown",
    f"""
    WITH {DIRTY_LINEITEM}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           COALESCE(l_returnflag, 'Unknown') AS l_returnflag,
           COALESCE(l_linestatus, 'Unknown') AS l_linestatus
    FROM dirty
    """,
)
def _(spark, sf):
    return fill(
        dirty_lineitem(spark, sf), {"l_returnflag": "Unknown", "l_linestatus": "Unknown"}
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
    )


@query(
    "coalesce_label",
    f"""
    WITH {DIRTY_LINEITEM}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           COALESCE(l_returnflag, l_linestatus) AS label
    FROM dirty
    """,
)
def _(spark, sf):
    return coalesce_into(dirty_lineitem(spark, sf), "label", "l_returnflag", "l_linestatus").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label"
    )


@query(
    "normalize_case",
    """
    SELECT c_custkey,
           UPPER(SUBSTR(c_mktsegment, 1, 1)) || LOWER(SUBSTR(c_mktsegment, 2)) AS c_mktsegment
    FROM customer
    """,
)
def _(spark, sf):
    return normalize_case(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"]
    )


_PART_LISTS = {
    "Compact": ["small", "economy"],
    "Bulk": ["large", "small"],
    "Everyday": ["standard", "medium"],
}


@query(
    "categorize",
    """
    SELECT p_partkey, p_type,
           CASE WHEN TRIM(LOWER(p_type)) IN ('small', 'economy') THEN 'Compact'
                WHEN TRIM(LOWER(p_type)) IN ('large', 'small') THEN 'Bulk'
                WHEN TRIM(LOWER(p_type)) IN ('standard', 'medium') THEN 'Everyday'
                ELSE 'Uncategorized' END AS category
    FROM part
    """,
)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    return categorize(parts, "p_type", _PART_LISTS, normalize=normalise_text)


@query(
    "categorize_table",
    """
    WITH map AS (
        SELECT p_brand, p_type,
               ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY MIN(p_partkey)) AS rn
        FROM part WHERE p_retailprice >= 1500 GROUP BY p_brand, p_type
    )
    SELECT p_partkey, p.p_brand, COALESCE(m.p_type, 'Uncategorized') AS category
    FROM part p LEFT JOIN map m ON p.p_brand = m.p_brand AND m.rn = 1
    """,
)
def _(spark, sf):
    parts = table(spark, sf, "part")
    mapping = (
        parts.where("p_retailprice >= 1500")
        .groupBy(F.col("p_brand").alias("value"), F.col("p_type").alias("category"))
        .agg(F.min("p_partkey").alias("rank"))
    )
    return categorize(parts.select("p_partkey", "p_brand"), "p_brand", mapping)


@query(
    "distinct_by",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem",
)
def _(spark, sf):
    return distinct_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"])


@query(
    "order_by_count",
    """
    SELECT p_brand, p_type, COUNT(*) AS rows FROM part
    GROUP BY p_brand, p_type ORDER BY rows DESC, p_brand, p_type
    """,
)
def _(spark, sf):
    counted = count_by(table(spark, sf, "part"), ["p_brand", "p_type"], name="rows")
    return order(counted, ["rows", "p_brand", "p_type"], descending=["rows"])


@query(
    "head_n",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000
    """,
)
def _(spark, sf):
    return head_n(
        table(spark, sf, "orders"), 1000, ["o_totalprice", "o_orderkey"], descending=["o_totalprice"]
    ).select("o_orderkey", "o_totalprice")


def _mistyped(spark, sf):
    """Nation names as parts misspell them: letters lost, changed or added by number."""
    name, at = F.lower("n_name"), (F.col("p_partkey") % 11 + 1).cast("int")
    kind = (F.col("p_partkey") % 8).cast("int")
    lost = F.overlay(name, F.lit(""), at, F.lit(1))
    changed = F.overlay(name, F.lit("x"), at, F.lit(1))
    added = F.overlay(name, F.lit("q"), at, F.lit(0))
    twice = F.overlay(lost, F.lit("zz"), F.lit(2), F.lit(1))
    typed = F.element_at(F.array(name, lost, changed, added, twice, F.reverse(lost), F.upper(changed), F.lit("")), kind + 1)
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf, "part")
    return part.join(nation, F.col("p_partkey") % 25 == F.col("n_nationkey")).select("p_partkey", typed.alias("typed"))


_MISTYPED = """
named AS (SELECT p_partkey, lower(n_name) AS name, CAST(p_partkey % 11 + 1 AS INTEGER) AS pos
          FROM part JOIN nation ON p_partkey % 25 = n_nationkey),
cut AS (SELECT *, substr(name, 1, pos - 1) || substr(name, pos + 1) AS lost,
               substr(name, 1, pos - 1) || 'x' || substr(name, pos + 1) AS changed,
               substr(name, 1, pos - 1) || 'q' || substr(name, pos) AS added FROM named),
typed AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN name WHEN 1 THEN lost WHEN 2 THEN changed WHEN 3 THEN added
                 WHEN 4 THEN substr(lost, 1, 1) || 'zz' || substr(lost, 3) WHEN 5 THEN reverse(lost)
                 WHEN 6 THEN upper(changed) ELSE '' END AS typed FROM cut),
spelled AS (SELECT lower(n_name) AS value, r_name AS category FROM nation JOIN region ON r_regionkey = n_regionkey),
best AS (
    SELECT text, arg_min(category, (edits, value)) AS category
    FROM (SELECT text, value, category, levenshtein(text, value) AS edits
          FROM (SELECT DISTINCT trim(lower(typed)) AS text FROM typed), spelled)
    WHERE edits <= CASE WHEN length(text) >= 7 THEN 2 WHEN length(text) >= 4 THEN 1 ELSE 0 END GROUP BY text)"""


@query(
    "fuzzy_categorize",
    f"""
    WITH {_MISTYPED}
    SELECT p_partkey, typed, COALESCE(category, 'Uncategorized') AS category
    FROM typed LEFT JOIN best ON text = trim(lower(typed))
    """,
)
def _(spark, sf):
    """Misspelt nations get the region of the nearest spelling; SQL compares all pairs."""
    spelled = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.lower("n_name").alias("value"), F.col("r_name").alias("category"), F.lit(1).alias("rank"))
    )
    return fuzzy_categorize(_mistyped(spark, sf), "typed", spelled, normalize=normalise_text)
