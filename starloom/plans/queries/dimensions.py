"""Dimension members, surrogate keys, the calendar and versioned dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from starloom.functions.columns import normalise_text
from starloom.operators.categorize import category_column
from starloom.operators.dates import date_dim
from starloom.operators.joins import not_in
from starloom.operators.keys import assign_keys, first_per_group, max_key, with_scalar
from starloom.operators.merge import scd2_merge
from starloom.operators.star import dimension_members
from starloom.plans.queries.inputs import moment
from starloom.plans.registry import query, table

OPENED, NOW = "2025-01-01 00:00:00", "2025-07-04 12:00:00"


@query(
    "date_dim",
    """
    SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key,
           CAST(d AS TIMESTAMP) AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
           CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
           CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
           CASE WHEN (month(d), day(d)) IN ((1, 1), (7, 4), (12, 25)) THEN 1 ELSE 0
                END AS is_holiday,
           CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
                WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
                WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' END AS holiday_name,
           CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
           CASE WHEN month(d) BETWEEN 7 AND 9 THEN 1 WHEN month(d) >= 10 THEN 2
                WHEN month(d) <= 3 THEN 3 ELSE 4 END AS fiscal_quarter,
           COUNT(*) AS rows
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
          UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)
    WHERE d BETWEEN DATE '1990-01-01' AND DATE '2030-12-31'
    GROUP BY d
    """,
)
def _(spark, sf):
    """Calendar rows of all order and ship days, with the rows on each."""
    days = (
        table(spark, sf, "orders")
        .select(F.col("o_orderdate").cast("date").alias("_day"))
        .unionAll(table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date")))
        .groupBy("_day")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    calendar = date_dim(spark, start=date(1990, 1, 1), full_date_type="timestamp_ntz")
    return calendar.join(days, F.col("full_date").cast("date") == F.col("_day")).drop("_day")


@query(
    "first_per_group",
    """
    SELECT c_nationkey, c_custkey, c_acctbal FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS rn FROM customer)
    WHERE rn = 1
    """,
)
def _(spark, sf):
    return first_per_group(
        table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal"),
        ["c_nationkey"],
        ["c_acctbal", "c_custkey"],
    )


@query(
    "surrogate_keys",
    """
    SELECT (SELECT COALESCE(MAX(s_suppkey), 0) FROM supplier)
           + ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) AS surrogate_key,
           c_custkey, c_acctbal
    FROM customer
    """,
)
def _(spark, sf):
    return assign_keys(
        table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
        ["c_acctbal", "c_custkey"],
        start=max_key(table(spark, sf, "supplier"), "s_suppkey"),
    )


@query(
    "with_scalar",
    """
    SELECT o_orderkey, m.max_key + o_orderkey AS shifted
    FROM orders CROSS JOIN (SELECT COALESCE(MAX(c_custkey), 0) AS max_key FROM customer) m
    """,
)
def _(spark, sf):
    top = max_key(table(spark, sf, "customer"), "c_custkey")
    return with_scalar(table(spark, sf, "orders").select("o_orderkey"), top).select(
        "o_orderkey", (F.col("max_key") + F.col("o_orderkey")).alias("shifted")
    )


@query(
    "not_in_current",
    """
    SELECT DISTINCT o_custkey, o_orderpriority FROM orders o
    WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND NOT EXISTS (
        SELECT 1 FROM orders p WHERE p.o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
          AND p.o_custkey = o.o_custkey AND p.o_orderpriority = o.o_orderpriority)
    """,
)
def _(spark, sf):
    pairs = ["o_custkey", "o_orderpriority"]
    orders = table(spark, sf, "orders")
    cut = moment("2000-01-01 00:00:00")
    new = orders.where(F.col("o_orderdate") >= cut).select(*pairs).distinct()
    return not_in(new, orders.where(F.col("o_orderdate") < cut), pairs)


_NAME_LISTS = {
    "Cold": ["blue ring", "green ring", "blue widget", "green widget"],
    "Warm": ["red ring", "red widget", "hot bolt", "blue ring"],
    "Sized": ["small ring", "large ring", "small widget", "large widget", "small bolt", "large bolt"],
}


def _case_sql(col: str) -> str:
    whens = " ".join(
        f"WHEN TRIM(LOWER({col})) IN ({', '.join(repr(v) for v in values)}) THEN '{name}'"
        for name, values in _NAME_LISTS.items()
    )
    return f"CASE {whens} ELSE 'Uncategorized' END"


def _name_category(col):
    return category_column(col, _NAME_LISTS, normalize=normalise_text)


@query(
    "dimension_members",
    f"""
    SELECT vehicle AS member, category FROM (
        SELECT vehicle, category, ROW_NUMBER() OVER (
            PARTITION BY TRIM(LOWER(vehicle)) ORDER BY vehicle) AS rn
        FROM (SELECT DISTINCT vehicle, {_case_sql("vehicle")} AS category FROM (
            SELECT CASE WHEN p_size <= 25 THEN UPPER(p_name) ELSE ' ' || p_name END AS vehicle
            FROM part)))
    WHERE rn = 1
    """,
)
def _(spark, sf):
    spellings = table(spark, sf, "part").select(
        F.when(F.col("p_size") <= 25, F.upper("p_name"))
        .otherwise(F.concat(F.lit(" "), "p_name"))
        .alias("member")
    )
    return dimension_members(
        spellings,
        ["member"],
        {"category": _name_category("member")},
        ["member"],
        key_expr=normalise_text,
    )


def _latest(orders):
    """One row per customer: priority and status of the last order."""
    last = first_per_group(
        orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]
    )
    return last.select("o_custkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))


def _opened(members, key, attrs):
    """A dimension holding ``members`` as first versions."""
    keyed = assign_keys(members.select(key, *attrs), [key])
    return keyed.select(
        "surrogate_key",
        key,
        *attrs,
        moment(OPENED).alias("effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(1).alias("is_current"),
    )


def _customer_versions(spark, sf, **options):
    orders = table(spark, sf, "orders")
    attrs = ["o_orderpriority", "o_orderstatus"]
    before = orders.where(F.col("o_orderdate") < moment("1996-01-01 00:00:00"))
    dim = _opened(_latest(before), "o_custkey", attrs)
    return scd2_merge(dim, _latest(orders), "o_custkey", attrs, moment(NOW), **options)


def _latest_sql(where: str) -> str:
    return f"""
        SELECT o_custkey, o_orderpriority, NULLIF(o_orderstatus, 'P') AS o_orderstatus FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders WHERE {where}) WHERE rn = 1"""


_NULL_SAFE = (
    "(d.o_orderpriority IS DISTINCT FROM s.o_orderpriority"
    " OR d.o_orderstatus IS DISTINCT FROM s.o_orderstatus)"
)
_PLAIN = (
    "COALESCE(d.o_orderpriority <> s.o_orderpriority OR d.o_orderstatus <> s.o_orderstatus, FALSE)"
)


def _versions_sql(changed: str, same_run: bool) -> str:
    numbered = (
        f"""SELECT s.*, d.o_custkey IS NULL AS is_new,
                   ROW_NUMBER() OVER (ORDER BY s.o_custkey) AS rn
            FROM source s LEFT JOIN dim d ON d.o_custkey = s.o_custkey
            WHERE d.o_custkey IS NULL OR {changed}"""
        if same_run
        else """SELECT s.*, d.o_custkey IS NULL AS is_new, s.rn
            FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY o_custkey) AS rn FROM source) s
            LEFT JOIN dim d ON d.o_custkey = s.o_custkey WHERE d.o_custkey IS NULL"""
    )
    return f"""
    WITH source AS ({_latest_sql("TRUE")}),
    dim AS (
        SELECT ROW_NUMBER() OVER (ORDER BY o_custkey) AS surrogate_key, *
        FROM ({_latest_sql("o_orderdate < TIMESTAMP '1996-01-01 00:00:00'")})),
    added AS ({numbered})
    SELECT d.surrogate_key, d.o_custkey, d.o_orderpriority, d.o_orderstatus,
           TIMESTAMP '{OPENED}' AS effective_date,
           CASE WHEN s.o_custkey IS NOT NULL AND {changed} THEN TIMESTAMP '{NOW}' END AS end_date,
           CASE WHEN s.o_custkey IS NOT NULL AND {changed} THEN 0 ELSE 1 END AS is_current
    FROM dim d LEFT JOIN source s ON s.o_custkey = d.o_custkey
    UNION ALL
    SELECT (SELECT MAX(surrogate_key) FROM dim) + rn, o_custkey, o_orderpriority, o_orderstatus,
           TIMESTAMP '{NOW}', NULL, 1
    FROM added
    """


@query("scd2_location", _versions_sql(_NULL_SAFE, same_run=True))
def _(spark, sf):
    return _customer_versions(spark, sf)


@query("scd2_location_next_run", _versions_sql(_NULL_SAFE, same_run=False))
def _(spark, sf):
    return _customer_versions(spark, sf, reopen="next_run")


@query("scd2_plain_test", _versions_sql(_PLAIN, same_run=True))
def _(spark, sf):
    return _customer_versions(spark, sf, null_safe=False)


@query("scd2_plain_test_next_run", _versions_sql(_PLAIN, same_run=False))
def _(spark, sf):
    return _customer_versions(spark, sf, null_safe=False, reopen="next_run")


def _text_versions(spark, sf, **options):
    """Members matched on trimmed lower-case text; unchanged ones filtered out first."""
    customer = table(spark, sf, "customer")
    dim = _opened(
        customer.where("c_acctbal < 5000").select(
            F.col("c_name").alias("member"), F.col("c_mktsegment").alias("category")
        ),
        "member",
        ["category"],
    )
    source = customer.select(
        F.concat(F.lit("  "), F.upper("c_name")).alias("member"),
        F.when(F.col("c_acctbal") < 1000, F.lit("LOW"))
        .otherwise(F.col("c_mktsegment"))
        .alias("category"),
    )
    key = normalise_text("member").alias("_key")
    unchanged = dim.where("is_current = 1").select(key, "category")
    source = not_in(source.select("*", key), unchanged, ["_key", "category"]).drop("_key")
    return scd2_merge(
        dim,
        source,
        "member",
        ["category"],
        moment(NOW),
        key_expr=normalise_text,
        null_safe=False,
        **options,
    )


def _text_versions_sql(added: str) -> str:
    return f"""
    WITH dim AS (
        SELECT ROW_NUMBER() OVER (ORDER BY c_name) AS surrogate_key, c_name AS member,
               c_mktsegment AS category, c_custkey
        FROM customer WHERE c_acctbal < 5000),
    source AS (
        SELECT '  ' || UPPER(c_name) AS member, TRIM(LOWER(c_name)) AS k,
               CASE WHEN c_acctbal < 1000 THEN 'LOW' ELSE c_mktsegment END AS category, c_acctbal
        FROM customer),
    joined AS (
        SELECT s.*, d.surrogate_key, d.category AS old
        FROM source s LEFT JOIN dim d ON TRIM(LOWER(d.member)) = s.k),
    numbered AS (
        SELECT *, ROW_NUMBER() OVER (ORDER BY k) AS rn
        FROM joined WHERE surrogate_key IS NULL OR category <> old),
    added AS (SELECT * FROM numbered WHERE {added})
    SELECT d.surrogate_key, d.member, d.category, TIMESTAMP '2025-01-01 00:00:00' AS effective_date,
           CASE WHEN c.c_acctbal < 1000 THEN TIMESTAMP '2025-07-04 12:00:00' END AS end_date,
           CASE WHEN c.c_acctbal < 1000 THEN 0 ELSE 1 END AS is_current
    FROM dim d JOIN customer c USING (c_custkey)
    UNION ALL
    SELECT (SELECT MAX(surrogate_key) FROM dim) + rn, member, category,
           TIMESTAMP '2025-07-04 12:00:00', NULL, 1 FROM added
    """


@query("scd2_prefilter", _text_versions_sql("TRUE"))
def _(spark, sf):
    return _text_versions(spark, sf)


@query("scd2_prefilter_next_run", _text_versions_sql("surrogate_key IS NULL"))
def _(spark, sf):
    return _text_versions(spark, sf, reopen="next_run")
