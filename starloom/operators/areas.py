"""Which area a point lies in: polygons over a grid of cells.

A cell that no edge touches lies wholly inside an area or outside, so its points
are answered by the cell alone. Points of the other cells are tested by the
crossings of a ray to the right with the few edges that pass their row of cells.
Holes and several polygons need no cases of their own: a point is inside if the
ray crosses the area's edges an odd number of times.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import keys_match

RINGS = "array<array<array<double>>>"
EDGE = ("x1", "y1", "x2", "y2")


def feature_areas(df: DataFrame, prop: str) -> DataFrame:
    """``(area, rings)``, a row per feature of GeoJSON feature collections.

    ``df`` has ``features: array<struct<properties: struct<...>, geometry:
    struct<type: string, coordinates: string>>>``: coordinates are read as text,
    since their depth depends on the type. ``Polygon`` and ``MultiPolygon`` are
    areas; other geometries, and malformed ones, have NULL rings.
    """
    each = df.select(F.explode("features").alias("f"))
    text, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    many = F.flatten(F.from_json(text, f"array<{RINGS}>"))
    rings = F.when(kind == "Polygon", F.from_json(text, RINGS)).when(kind == "MultiPolygon", many)
    return each.select(F.col(f"f.properties.{prop}").alias("area"), rings.alias("rings"))


def area_edges(areas: DataFrame) -> DataFrame:
    """``(area, x1, y1, x2, y2)``: the edges of ``(area, rings)``; open rings are closed.

    Areas without a name or rings have no edges, nor do vertices without two numbers.
    """
    ring = areas.where("area is not null").select("area", F.explode("rings").alias("ring"))
    points = F.filter("ring", lambda p: (F.size(p) >= 2) & F.get(p, 0).isNotNull() & F.get(p, 1).isNotNull())
    ring = ring.select("area", points.alias("p")).where("size(p) > 2")
    after = F.concat(F.slice("p", 2, 1 << 30), F.slice("p", 1, 1))
    pairs = F.zip_with("p", after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    edge = ring.select("area", F.explode(pairs).alias("e"))
    ends = [F.get(F.col(f"e.{end}"), i).alias(n) for n, end, i in zip(EDGE, "aabb", (0, 1, 0, 1))]
    return edge.select("area", *ends).where("x1 <> x2 or y1 <> y2")


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size))


def _crosses(e: Column, x: Column | None, y: Column) -> Column:
    """Whether a ray to the right from ``(x, y)`` crosses the edge; of a whole line without ``x``."""
    passes = (e["y1"] > y) != (e["y2"] > y)
    return passes if x is None else passes & (x < _crossing(e, y))


def _crossing(e: Column, y: Column) -> Column:
    """Where the line of height ``y`` meets the edge."""
    rise = F.when(e["y2"] != e["y1"], e["y2"] - e["y1"])
    return (e["x2"] - e["x1"]) * (y - e["y1"]) / rise + e["x1"]


def area_index(edges: DataFrame, cell: float) -> DataFrame:
    """``(cx, cy, candidates)``: per cell of width ``cell`` the areas that cover or cut it.

    A candidate has ``area`` and ``edges``: NULL if the area covers the whole cell,
    else those edges that rays from the cell can meet. It is as large as the areas
    are in cells; points have no part in it.
    """
    tiny = 1e-9
    size = F.lit(cell)
    edge = F.struct(*EDGE).alias("edge")
    rows = F.sequence(
        _cell(F.least("y1", "y2"), cell) - 1, _cell(F.greatest("y1", "y2"), cell) + 1
    )
    by_row = edges.select("area", edge, F.explode(rows).alias("cy"))
    e = F.col("edge")
    low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    # The stretch of the edge within the row, a little wider than exact.
    bottom = F.greatest(low, F.col("cy") * size)
    top = F.least(high, (F.col("cy") + 1) * size)
    flat = e["y1"] == e["y2"]
    at_bottom, at_top = F.coalesce(_crossing(e, bottom), e["x1"]), F.coalesce(_crossing(e, top), e["x2"])
    least, most = F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
    left = F.when(flat, least).otherwise(F.least(most, F.greatest(least, F.least(at_bottom, at_top))))
    right = F.when(flat, most).otherwise(F.greatest(least, F.least(most, F.greatest(at_bottom, at_top))))
    near = (low <= (F.col("cy") + 1 + tiny) * size) & (high >= (F.col("cy") - tiny) * size)
    passing = by_row.where(near).select("area", "cy", "edge", left.alias("left"), right.alias("right"))
    columns = F.sequence(F.floor(F.col("left") / size - tiny), F.floor(F.col("right") / size + tiny))
    border = passing.select("area", "cy", F.explode(columns).alias("cx")).distinct()

    lines = passing.groupBy("area", "cy").agg(F.collect_list(F.struct("edge", "right")).alias("line"))
    held = F.filter("line", lambda p: p["right"] >= (F.col("cx") - tiny) * size)
    cut = border.join(lines, ["area", "cy"]).select(
        "area", "cx", "cy", F.transform(held, lambda p: p["edge"]).alias("edges")
    )
    middle = (F.col("cy") + 0.5) * size
    meets = F.transform(
        F.filter("line", lambda p: _crosses(p["edge"], None, middle)), lambda p: _crossing(p["edge"], middle)
    )
    sorted_ = lines.select("area", "cy", F.array_sort(meets).alias("meets")).where("size(meets) > 1")
    spans = sorted_.select(
        "area", "cy", "meets", F.explode(F.sequence(F.lit(0), F.size("meets") - 2, F.lit(2))).alias("k")
    )
    first = F.ceil(F.get("meets", F.col("k")) / size - 0.5)
    last = F.floor(F.get("meets", F.col("k") + 1) / size - 0.5)
    covered = spans.select("area", "cy", first.alias("first"), last.alias("last")).where("first <= last")
    covered = covered.select("area", F.explode(F.sequence("first", "last")).alias("cx"), "cy")
    inner = covered.distinct().join(border, ["area", "cx", "cy"], "left_anti")
    no_edges = F.lit(None).cast(cut.schema["edges"].dataType)
    every = cut.unionByName(inner.withColumn("edges", no_edges))
    return every.groupBy("cx", "cy").agg(F.sort_array(F.collect_list(F.struct("area", "edges"))).alias("candidates"))


def within_areas(
    df: DataFrame, x: str, y: str, index: DataFrame, cell: float, out: str = "area"
) -> DataFrame:
    """``df`` with the area each point lies in; NULL outside all, and for NULL or
    infinite coordinates. Where areas overlap the least name is taken.

    A point on an edge that two areas share is in one of them. Points are joined on
    their cell: a cell that holds a third of them is split as any hot key.
    """
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    fits = (F.abs(px) < 1e12) & (F.abs(py) < 1e12)
    placed = df.withColumns(
        {"_cx": F.when(fits, _cell(px, cell)), "_cy": F.when(fits, _cell(py, cell))}
    )
    cells = index.select(F.col("cx").alias("_icx"), F.col("cy").alias("_icy"), F.col("candidates").alias("_held"))
    met = placed.join(cells, keys_match(placed, [("_cx", "_icx"), ("_cy", "_icy")]), "left")

    def holds(c: Column) -> Column:
        odd = F.size(F.filter(c["edges"], lambda e: F.coalesce(_crosses(e, px, py), F.lit(False)))) % 2 == 1
        return c["edges"].isNull() | odd

    return met.select(*df.columns, F.get(F.filter("_held", holds), 0)["area"].alias(out))


def fill_from_areas(
    df: DataFrame, areas: DataFrame, label: str, x: str, y: str, cell: float, default: Any = None
) -> DataFrame:
    """Fill a missing ``label`` by the area ``(area, rings)`` the row's point lies in."""
    index = area_index(area_edges(areas), cell)
    found = within_areas(df, x, y, index, cell, "_area")
    value = F.coalesce(label, "_area", *([F.lit(default)] if default is not None else []))
    return found.select(*[value.alias(c) if c == label else F.col(c) for c in df.columns])
