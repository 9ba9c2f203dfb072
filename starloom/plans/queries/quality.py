"""Profiles, duplicates, the error log and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.clean import CleanSpec, clean
from starloom.operators.duplicates import duplicate_keys, duplicate_rows
from starloom.operators.profile import null_profile, numeric_profile
from starloom.operators.quality import (
    DuplicateRule,
    NullRule,
    ValueRule,
    drop_failing,
    error_counts,
    find_errors,
    log_errors,
)
from starloom.plans.queries.inputs import (
    DIRTY_CUSTOMER,
    DIRTY_LINEITEM,
    dirty_customer,
    dirty_lineitem,
    moment,
)
from starloom.plans.registry import query, table


@query(
    "null_profile",
    f"""
    WITH {DIRTY_CUSTOMER}
    SELECT COUNT(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey,
           COUNT(*) FILTER (WHERE c_name IS NULL) AS c_name,
           COUNT(*) FILTER (WHERE c_nationkey IS NULL) AS c_nationkey,
           COUNT(*) FILTER (WHERE c_acctbal IS NULL) AS c_acctbal,
           COUNT(*) FILTER (WHERE c_mktsegment IS NULL) AS c_mktsegment
    FROM dirty
    """,
)
def _(spark, sf):
    return null_profile(dirty_customer(spark, sf))


@query(
    "numeric_profile",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", COUNT({c}) AS "count", ROUND(AVG({c}), 4) AS mean,
               ROUND(STDDEV_SAMP({c}), 4) AS stddev,
               CAST(MIN({c}) AS DOUBLE) AS "min", CAST(MAX({c}) AS DOUBLE) AS "max"
        FROM part"""
        for c in ("p_partkey", "p_size", "p_retailprice")
    ),
)
def _(spark, sf):
    return numeric_profile(table(spark, sf, "part")).withColumns(
        {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    )


@query(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
    """,
)
def _(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], name="copies")


@query(
    "duplicate_rows",
    """
    SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) IN (
        SELECT (l_orderkey, l_linenumber) FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
    """,
)
def _(spark, sf):
    return duplicate_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_rows_nullsafe",
    f"""
    WITH {DIRTY_LINEITEM}, repeated AS (
        SELECT l_returnflag, l_partkey, l_quantity FROM dirty
        GROUP BY ALL HAVING COUNT(*) > 1)
    SELECT d.* FROM dirty d JOIN repeated r
      ON d.l_returnflag IS NOT DISTINCT FROM r.l_returnflag
     AND d.l_partkey = r.l_partkey
     AND d.l_quantity IS NOT DISTINCT FROM r.l_quantity
    """,
)
def _(spark, sf):
    return duplicate_rows(dirty_lineitem(spark, sf), ["l_returnflag", "l_partkey", "l_quantity"])


@query(
    "duplicate_rows_plain",
    f"""
    WITH {DIRTY_LINEITEM}, repeated AS (
        SELECT l_returnflag, l_partkey, l_quantity FROM dirty
        GROUP BY ALL HAVING COUNT(*) > 1)
    SELECT d.* FROM dirty d JOIN repeated r
      ON d.l_returnflag = r.l_returnflag AND d.l_partkey = r.l_partkey
     AND d.l_quantity = r.l_quantity
    """,
)
def _(spark, sf):
    return duplicate_rows(
        dirty_lineitem(spark, sf), ["l_returnflag", "l_partkey", "l_quantity"], null_safe=False
    )


_IDENTITY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_RULES = [
    NullRule(
        error_type="NULL_CHECK",
        columns_checked="flag$qty",
        severity="High",
        description="Flag and quantity missing",
        identity=_IDENTITY,
        columns=("l_returnflag", "l_quantity"),
    ),
    ValueRule(
        error_type="Value_check",
        columns_checked="discount$tax",
        severity="High",
        description="Discount and tax are zero",
        identity=_IDENTITY,
        values={"l_discount": 0.0, "l_tax": 0.0},
    ),
    NullRule(
        error_type="Null_check",
        columns_checked="flag",
        severity="Medium",
        description="Flag missing",
        identity=_IDENTITY,
        columns=("l_returnflag",),
    ),
    DuplicateRule(
        error_type="Duplicate_check",
        columns_checked="l_orderkey,l_linenumber",
        severity="Low",
        description="Line number repeated",
        keys=("l_orderkey", "l_linenumber"),
    ),
]
_PICK = ["l_partkey", "l_suppkey", "l_shipdate", "l_discount", "l_tax"]
_NOW = "2025-07-04 12:00:00"
_EARLIER = "l_shipdate < timestamp_ntz'1998-01-01 00:00:00'"


def _errors_sql(source: str) -> str:
    ident = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
    return f"""
        SELECT 'NULL_CHECK' AS error_type, 'High' AS severity, 'flag$qty' AS columns_checked,
               'Flag and quantity missing' AS error_description, {ident} AS row_identifier,
               l_orderkey, l_shipdate
        FROM {source} WHERE l_returnflag IS NULL AND l_quantity IS NULL
        UNION ALL
        SELECT 'Value_check', 'High', 'discount$tax', 'Discount and tax are zero', {ident},
               l_orderkey, l_shipdate
        FROM {source} WHERE l_discount = 0 AND l_tax = 0
        UNION ALL
        SELECT 'Null_check', 'Medium', 'flag', 'Flag missing', {ident}, l_orderkey, l_shipdate
        FROM {source} WHERE l_returnflag IS NULL
        UNION ALL
        SELECT 'Duplicate_check', 'Low', 'l_orderkey,l_linenumber', 'Line number repeated',
               concat_ws('-', l_orderkey, l_linenumber), l_orderkey, l_shipdate
        FROM {source} WHERE (l_orderkey, l_linenumber) IN (
            SELECT (l_orderkey, l_linenumber) FROM {source}
            GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)"""


@query(
    "error_log_new",
    f"""
    WITH {DIRTY_LINEITEM},
    earlier AS (SELECT * FROM dirty WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
    logged AS ({_errors_sql("earlier")}),
    errors AS ({_errors_sql("dirty")})
    SELECT 'lineitem' AS table_name, TIMESTAMP '{_NOW}' AS error_timestamp, e.*
    FROM errors e WHERE NOT EXISTS (
        SELECT 1 FROM logged g
        WHERE g.row_identifier = e.row_identifier AND g.error_type = e.error_type
          AND g.columns_checked = e.columns_checked)
    """,
)
def _(spark, sf):
    dirty = dirty_lineitem(spark, sf)
    options = {
        "table_name": "lineitem",
        "now": moment(_NOW),
        "keep": ("l_orderkey", "l_shipdate"),
        "identifier": "text",
    }
    log = find_errors(dirty.where(_EARLIER), _RULES, **options)
    return log_errors(dirty, _RULES, log, **options)


@query(
    "error_log_two_tables",
    f"""
    WITH {DIRTY_LINEITEM}, errors AS ({_errors_sql("dirty")})
    SELECT 'lineitem_copy' AS table_name, TIMESTAMP '{_NOW}' AS error_timestamp, e.* FROM errors e
    """,
)
def _(spark, sf):
    """A shared log that has all errors of another table with the same records."""
    dirty = dirty_lineitem(spark, sf)
    options = {"now": moment(_NOW), "keep": ("l_orderkey", "l_shipdate"), "identifier": "text"}
    log = find_errors(dirty, _RULES, table_name="lineitem", **options)
    return log_errors(dirty, _RULES, log, table_name="lineitem_copy", **options)


@query(
    "error_counts",
    f"""
    WITH {DIRTY_LINEITEM}, errors AS ({_errors_sql("dirty")})
    SELECT TIMESTAMP '{_NOW}' AS error_timestamp,
           CASE error_type WHEN 'NULL_CHECK' THEN 'Null_check' ELSE error_type END AS error_type,
           columns_checked, severity, CAST(l_shipdate AS DATE) AS extraction_date,
           COUNT(*) AS "count"
    FROM errors GROUP BY ALL
    """,
)
def _(spark, sf):
    log = find_errors(
        dirty_lineitem(spark, sf),
        _RULES,
        table_name="lineitem",
        now=moment(_NOW),
        keep=("l_shipdate",),
        identifier="text",
    )
    return error_counts(log, batch_col="l_shipdate")


@query(
    "clean_orders",
    f"""
    WITH {DIRTY_LINEITEM}, ranked AS (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_shipdate, l_discount, l_tax) AS rn
        FROM dirty
        WHERE l_returnflag IS NOT NULL AND l_quantity IS NOT NULL
          AND l_discount <> 0 AND l_tax <> 0)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(l_quantity AS INTEGER) AS l_quantity, l_discount, l_tax, l_returnflag,
           COALESCE(l_linestatus, 'Unknown') AS l_linestatus,
           CAST(l_shipdate AS DATE) AS l_shipdate
    FROM ranked WHERE rn = 1
    """,
)
def _(spark, sf):
    return clean(
        dirty_lineitem(spark, sf),
        CleanSpec(
            casts={"l_quantity": "int", "l_shipdate": "date"},
            required=["l_returnflag", "l_quantity"],
            sentinels={"l_discount": 0.0, "l_tax": 0.0},
            dedupe_keys=["l_orderkey", "l_linenumber"],
            dedupe_order=_PICK,
            defaults={"l_linestatus": "Unknown"},
        ),
    )


@query(
    "drop_failing",
    f"""
    WITH {DIRTY_LINEITEM}
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_shipdate, l_discount, l_tax) AS rn
        FROM dirty
        WHERE l_returnflag IS NOT NULL AND NOT (l_discount = 0 AND l_tax = 0))
    WHERE rn = 1
    """,
)
def _(spark, sf):
    return drop_failing(dirty_lineitem(spark, sf), _RULES, order=_PICK)
