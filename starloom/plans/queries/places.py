"""Nearest reference points and nested feature collections."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.geo import flatten_features
from starloom.operators.areas import area_edges, area_index, within_areas
from starloom.operators.nearest import Axis, band_join, fill_from_nearest, nearest
from starloom.plans.queries.inputs import DIRTY_CUSTOMER, dirty_customer
from starloom.plans.registry import query, table


@query(
    "nearest_fill",
    f"""
    WITH {DIRTY_CUSTOMER}, ranked AS (
        SELECT d.*, s.s_name, ROW_NUMBER() OVER (
            PARTITION BY d.c_custkey
            ORDER BY (d.c_acctbal - s.s_acctbal) * (d.c_acctbal - s.s_acctbal)
                   + (d.c_nationkey - s.s_nationkey) * (d.c_nationkey - s.s_nationkey),
                     s.s_suppkey) AS rn
        FROM dirty d LEFT JOIN supplier s
          ON ABS(d.c_acctbal - s.s_acctbal) < 100 AND ABS(d.c_nationkey - s.s_nationkey) < 3)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           COALESCE(c_mktsegment, s_name, 'Unknown') AS c_mktsegment
    FROM ranked WHERE rn = 1
    """,
)
def _(spark, sf):
    return fill_from_nearest(
        dirty_customer(spark, sf),
        table(spark, sf, "supplier"),
        "c_mktsegment",
        Axis("c_acctbal", "s_acctbal", 100.0),
        Axis("c_nationkey", "s_nationkey", 3.0),
        ref_label="s_name",
        tie="s_suppkey",
    )


@query(
    "nearest_many_refs",
    """
    SELECT s_suppkey, c_name AS nearest, ROUND(SQRT(d2), 6) AS distance FROM (
        SELECT s_suppkey, c_name,
               (s_acctbal - c_acctbal) * (s_acctbal - c_acctbal)
             + (s_nationkey - c_nationkey) * (s_nationkey - c_nationkey) AS d2,
               ROW_NUMBER() OVER (PARTITION BY s_suppkey ORDER BY
                   (s_acctbal - c_acctbal) * (s_acctbal - c_acctbal)
                 + (s_nationkey - c_nationkey) * (s_nationkey - c_nationkey), c_custkey) AS rn
        FROM supplier LEFT JOIN customer
          ON ABS(s_acctbal - c_acctbal) < 1000 AND ABS(s_nationkey - c_nationkey) < 5)
    WHERE rn = 1
    """,
)
def _(spark, sf):
    """Many references per band: searched through nested grids."""
    return nearest(
        table(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey"),
        table(spark, sf, "customer"),
        Axis("s_acctbal", "c_acctbal", 1000.0),
        Axis("s_nationkey", "c_nationkey", 5.0),
        label="c_name",
        tie="c_custkey",
    ).select("s_suppkey", "nearest", F.round("distance", 6).alias("distance"))


@query(
    "band_join",
    """
    WITH levels AS (SELECT DISTINCT CAST(FLOOR(value) AS DOUBLE) AS level FROM events)
    SELECT event_id, value, level FROM events LEFT JOIN levels
      ON ABS(value - level) < 0.75
    """,
)
def _(spark, sf):
    """Events with the whole values near theirs: two at most, by construction."""
    events = table(spark, sf, "events").select("event_id", "value")
    levels = events.select(F.floor("value").cast("double").alias("level")).distinct()
    return band_join(events, levels, [Axis("value", "level", 0.75)])


@query(
    "geo_flatten",
    """
    SELECT vec_id, 'area ' || label AS borough,
           CAST(embedding[1] AS DOUBLE) AS longitude, CAST(embedding[2] AS DOUBLE) AS latitude
    FROM embeddings
    UNION ALL
    SELECT vec_id, 'empty', NULL, NULL FROM embeddings
    """,
)
def _(spark, sf):
    """Each embedding row as a collection of a two-vertex polygon and an empty one."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    ring = F.array(F.array(at(0), at(1)), F.array(at(2), at(3)))
    feature = lambda name, coords: F.struct(
        F.struct(name.alias("borough")).alias("properties"),
        F.struct(coords.cast("array<array<array<double>>>").alias("coordinates")).alias("geometry"),
    )
    collections = table(spark, sf, "embeddings").select(
        "vec_id",
        F.array(
            feature(F.concat(F.lit("area "), F.col("label").cast("string")), F.array(ring)),
            feature(F.lit("empty"), F.array()),
        ).alias("features"),
    )
    return flatten_features(collections, keep=("vec_id",))


#: A bent outline with a hole, and a triangle apart, within a square of ten by ten.
_OUTLINE = ((0.0, 0.0), (7.3, 1.1), (9.1, 6.2), (5.2, 4.4), (3.9, 9.0), (1.2, 6.7))
_HOLE = ((2.1, 2.3), (4.4, 2.2), (3.1, 3.9))
_APART = ((8.0, 8.0), (9.9, 8.3), (8.6, 9.7))


def _areas(spark, sf):
    """A polygon with a hole per nation, and a second one for every third."""

    def ring(points):
        shift = [(F.col("n_nationkey") % 5) * 10, F.floor(F.col("n_nationkey") / 5) * 10]
        return F.array(*[F.array(*[(F.lit(v) + s).cast("double") for v, s in zip(p, shift)]) for p in points])

    one = F.array(ring(_OUTLINE), ring(_HOLE))
    two = F.array(ring(_OUTLINE), ring(_HOLE), ring(_APART))
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("area"), F.when(F.col("n_nationkey") % 3 == 0, two).otherwise(one).alias("rings")
    )


_SIDES = ", ".join(
    f"({k}, {a[0]}, {a[1]}, {b[0]}, {b[1]})"
    for k, ring in enumerate((_OUTLINE, _HOLE, _APART))
    for a, b in zip(ring, ring[1:] + ring[:1])
)


@query(
    "area_of_points",
    f"""
    WITH sides AS (
        SELECT n_name AS area, x1 + (n_nationkey % 5) * 10 AS x1, y1 + (n_nationkey // 5) * 10 AS y1,
               x2 + (n_nationkey % 5) * 10 AS x2, y2 + (n_nationkey // 5) * 10 AS y2
        FROM nation, (VALUES {_SIDES}) AS s(ring, x1, y1, x2, y2) WHERE ring < 2 OR n_nationkey % 3 = 0),
    points AS (
        SELECT o_orderkey, ((o_orderkey * 7919) % 52013)::DOUBLE / 1000.7 AS x,
               ((o_orderkey * 104729) % 51001)::DOUBLE / 1000.3 AS y FROM orders),
    crossed AS (
        SELECT o_orderkey, area, count(*) AS n FROM points, sides
        WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY ALL),
    inside AS (SELECT o_orderkey, min(area) AS area FROM crossed WHERE n % 2 = 1 GROUP BY o_orderkey)
    SELECT o_orderkey, x, y, area FROM points LEFT JOIN inside USING (o_orderkey)
    """,
)
def _(spark, sf):
    """Orders spread over a map, and the area that holds each; SQL tests every edge."""
    points = table(spark, sf, "orders").select(
        "o_orderkey",
        ((F.col("o_orderkey") * 7919 % 52013).cast("double") / 1000.7).alias("x"),
        ((F.col("o_orderkey") * 104729 % 51001).cast("double") / 1000.3).alias("y"),
    )
    index = area_index(area_edges(_areas(spark, sf)), 0.5)
    return within_areas(points, "x", "y", index, 0.5)
