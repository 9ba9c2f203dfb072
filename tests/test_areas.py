"""Points are in the areas that a ray tells, by cells or by all edges."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F
from test_skew import N, executed, skewed  # noqa: F401
from test_warehouse import DAY1, config, crashes

from starloom.operators.areas import RINGS, area_edges, area_index, feature_areas, fill_from_areas, within_areas
from starloom.plans.warehouse import run_pipeline
from starloom.sources.readers import read_json


def brute(areas, x, y):
    if x is None or y is None or not math.isfinite(x) or not math.isfinite(y):
        return None
    found = []
    for name, rings in areas:
        odd = False
        for ring in rings or ():
            points = [p for p in ring if len(p) > 1]
            for (x1, y1, *_), (x2, y2, *_) in zip(points, points[1:] + points[:1]):
                if len(points) > 2 and (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
        if odd and name is not None:
            found.append(name)
    return min(found, default=None)


def star(rng, cx, cy, size, n):
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [[cx + size * (0.3 + rng.random()) * math.cos(t), cy + size * (0.3 + rng.random()) * math.sin(t)] for t in turns]


def some_areas():
    rng = random.Random(6)
    out = []
    for k in range(6):
        cx, cy = rng.uniform(-3, 3), rng.uniform(-3, 3)
        ring = star(rng, cx, cy, 1.5, 9)
        out.append((f"area{k}", [ring + ring[:1], star(rng, cx, cy, 0.4, 5), star(rng, cx + 4, cy, 0.6, 4)]))
    out.append(("square", [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]], [[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5]]]))
    out.append(("flat", [[[5.0, 5.0], [8.0, 5.0 + 1e-13], [8.0, 5.5], [5.0, 5.5]]]))
    return [*out, ("none", None), ("empty", []), ("dot", [[[1.0, 1.0]] * 4]), ("short", [[[1.0], [2.0, 3.0], [2.5, 3.5]]]), (None, out[0][1])]


@pytest.mark.parametrize("cell", [0.1, 7.0])
def test_as_all_edges_tell(spark, rows, cell):
    areas, rng = some_areas(), random.Random(8)
    points = [(rng.uniform(-6, 9), rng.uniform(-6, 7)) for _ in range(1500)]
    points += [(a / 4, b / 4) for a in range(-4, 14) for b in range(-4, 14)]  # on edges, corners and cell borders
    points += [(None, 1.0), (1.0, None), (math.nan, 1.0), (math.inf, 1.0), (1e300, 1.0)]
    df = spark.createDataFrame([(*p, "kept") for p in points], "x double, y double, candidates string")
    frame = spark.createDataFrame(areas, f"area string, rings {RINGS}")
    got = within_areas(df, "x", "y", area_index(area_edges(frame), cell), cell)
    assert got.columns == ["x", "y", "candidates", "area"]
    found = [(r.x, r.y, r.area) for r in got.collect()]
    assert len(found) == len(points)
    assert [(x, y, a) for x, y, a in found if a != brute(areas, x, y)] == []
    assert len({a for *_, a in found}) > 7


def test_most_points_meet_no_edge(spark):
    """Inner cells carry no edges; border cells only those that pass their row."""
    square = [("a", [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]]])]
    index = area_index(area_edges(spark.createDataFrame(square, f"area string, rings {RINGS}")), 1.0)
    cells = index.select(F.inline("candidates")).select(F.coalesce(F.size("edges"), F.lit(0)).alias("n"), F.col("edges").isNull().alias("inner"))
    assert cells.where("inner").count() == 64 and cells.agg(F.max("n")).first()[0] <= 4


def test_features_of_either_kind(spark, rows, tmp_path):
    one = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]
    two = [[[[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]]], [[[20, 0], [22, 0], [22, 2], [20, 2], [20, 0]]]]
    features = [
        {"properties": {"borough": "One"}, "geometry": {"type": "Polygon", "coordinates": one}},
        {"properties": {"borough": "Two"}, "geometry": {"type": "MultiPolygon", "coordinates": two}},
        {"properties": {"borough": "Dot"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"properties": {"borough": "Gone"}, "geometry": None},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"features": features}, indent=1))
    schema = "features array<struct<properties: struct<borough: string>, geometry: struct<type: string, coordinates: string>>>"
    areas = feature_areas(read_json(spark, str(tmp_path), schema), "borough")
    assert areas.where("rings is null").count() == 2
    df = spark.createDataFrame([(3.0, 3.0, None), (1.5, 1.5, None), (21.0, 1.0, None), (11.0, 1.0, "Kept")], "x double, y double, borough string")
    filled = fill_from_areas(df, areas, "borough", "x", "y", 0.5, "Unknown")
    assert rows(filled) == rows(spark.createDataFrame([(3.0, 3.0, "One"), (1.5, 1.5, "Unknown"), (21.0, 1.0, "Two"), (11.0, 1.0, "Kept")], df.schema))
    assert fill_from_areas(df, areas.limit(0), "borough", "x", "y", 0.5).where("borough is null").count() == 3


def test_a_hot_place_is_split(spark, skewed):  # noqa: F811
    square = [("a", [[[0.0, 0.0], [1.9, 0.0], [1.9, 1.9], [0.0, 1.9]]])]
    index = area_index(area_edges(spark.createDataFrame(square, f"area string, rings {RINGS}")), 0.5)
    points = skewed.select(F.col("k").cast("double").alias("x"), F.lit(1.7).alias("y"), "payload")
    count, plan = executed(within_areas(points, "x", "y", index, 0.5))
    assert count == N and "skew=true" in plan


def test_boroughs_by_area_then_by_point(spark, rows, db):
    """Record 2 has no borough; it lies in an area and near another's reference point."""
    ring = [[-73.9, 40.8], [-73.85, 40.8], [-73.85, 40.9], [-73.9, 40.9]]
    areas = spark.createDataFrame([("kings", [ring])], f"area string, rings {RINGS}")
    cfg = config(spark, borough_areas=areas)
    run_pipeline(crashes(spark), cfg, DAY1)
    found = dict(rows(spark.table(cfg.silver), "collision_id", "borough"))
    assert found == {"1": "Bronx", "2": "Kings", "3": "Unknown", "4": "Queens", "8": "Queens"}
