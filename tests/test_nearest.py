import math
import random

import pytest

from starloom.functions.geo import FEATURE_COLLECTION, flatten_features
from starloom.operators.nearest import Axis, _depth, _points, band_join, fill_from_nearest, nearest
from starloom.sources.readers import read_json

X, Y = Axis("x", "rx", 0.072), Axis("y", "ry", 0.095)


def left_frame(spark, points):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double")


def ref_frame(spark, points):
    return spark.createDataFrame(
        [(i, f"r{i}", *p) for i, p in enumerate(points)], "rid int, name string, rx double, ry double"
    )


def brute(points, refs, rx=X.radius, ry=Y.radius):
    out = []
    for i, (x, y) in enumerate(points):
        best = None
        if x is not None and y is not None:
            for j, (a, b) in enumerate(refs):
                if abs(x - a) < rx and abs(y - b) < ry:
                    d = ((x - a) * (x - a) + (y - b) * (y - b), j)
                    best = d if best is None or d < best else best
        out.append((i, None if best is None else f"r{best[1]}", None if best is None else math.sqrt(best[0])))
    return out


def found(spark, points, refs, **options):
    out = nearest(left_frame(spark, points), ref_frame(spark, refs), X, Y, label="name", tie="rid", **options)
    return sorted((r["id"], r["nearest"], r["distance"]) for r in out.collect())


def clustered(seed, n, spread):
    rng = random.Random(seed)
    centres = [(rng.uniform(40, 41), rng.uniform(-74, -73)) for _ in range(3)]
    out = []
    for _ in range(n):
        cx, cy = rng.choice(centres)
        out.append((cx + rng.gauss(0, spread), cy + rng.gauss(0, spread)))
    return out


@pytest.mark.parametrize("small_refs", [100_000, 0])
@pytest.mark.parametrize("seed, spread", [(1, 0.3), (2, 0.01), (3, 0.0005)])
def test_nearest_equals_brute_force(spark, small_refs, seed, spread):
    refs = clustered(seed, 400, spread)
    points = clustered(seed, 200, spread * 3) + [(None, 1.0), (1.0, None)] + refs[:5] * 3
    assert found(spark, points, refs, small_refs=small_refs) == brute(points, refs)


@pytest.mark.parametrize("small_refs", [100_000, 0])
def test_ties_radius_and_repeated_places(spark, small_refs):
    refs = [(0.01, 0.0), (-0.01, 0.0), (5.0, 5.0), (5.0, 5.0), (9.0, 9.0)]
    points = [(0.0, 0.0), (5.0, 5.0), (9.0 + 0.072, 9.0), (9.0 + 0.0719, 9.0), (20.0, 20.0)] * 2
    got = found(spark, points, refs, small_refs=small_refs)
    assert got == brute(points, refs)
    assert [g[1] for g in got[:5]] == ["r0", "r2", brute(points, refs)[2][1], "r4", None]


def test_lattice_with_exact_ties(spark):
    refs = [(i * 0.01, j * 0.01) for i in range(20) for j in range(20)]
    points = [(i * 0.005, j * 0.005) for i in range(30) for j in range(10)]
    assert found(spark, points, refs, small_refs=0) == brute(points, refs)


def test_search_goes_as_deep_as_the_references_are_dense(spark):
    dense = clustered(3, 600, 0.0005)
    places = _points(ref_frame(spark, dense), X, Y, "name", "rid")
    assert _depth(places, X, Y) >= 2
    assert _depth(_points(ref_frame(spark, dense[:20]), X, Y, "name", "rid"), X, Y) == 0


def test_both_forms_agree_off_the_map(spark):
    inf, nan = float("inf"), float("nan")
    refs = [(0.0, 0.0), (1e300, 1e300), (-1e300, 0.0), (inf, 0.0), (nan, 0.0), (0.01, -inf), (None, 0.0)]
    refs += [(1.6e8, 1.6e8), (1.6e8, 1.6e8 + 0.05)]
    points = [(0.01, 0.01), (1e300, 1e300), (inf, 0.0), (nan, nan), (None, 0.0), (0.0, None), (-1e300, 0.05)]
    points += [(1.6e8 + 0.01, 1.6e8 + 0.04), (1.6e8, 1.6e8)]
    for small in (100_000, 0):
        assert found(spark, points, refs, small_refs=small) == brute(points, [(nan, nan) if a is None else (a, b) for a, b in refs])


def test_references_on_a_ring(spark):
    ring = [(0.06 * math.cos(k / 300), 0.06 * math.sin(k / 300)) for k in range(1800)]
    points = [(0.0, 0.0), (0.001, 0.0), (0.05, 0.03)]
    assert found(spark, points, ring, small_refs=0) == brute(points, ring)


def test_rows_without_a_place_are_not_shuffled(spark):
    refs = ref_frame(spark, [(0.1, 0.1)])
    points = [(None, 0.1)] * 3
    plan = nearest(
        left_frame(spark, points), refs, X, Y, label="name", tie="rid", small_refs=0
    )._jdf.queryExecution().sparkPlan().toString()
    branch = plan[plan.rindex("Filter"):]
    assert "Join" not in branch and "Aggregate" not in branch


def test_no_references(spark):
    points = [(1.0, 1.0), (None, None)]
    for small in (100, 0):
        assert found(spark, points, [], small_refs=small) == [(0, None, None), (1, None, None)]


def test_band_join_equals_nested_loop(spark):
    rng = random.Random(5)
    points = [(rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(150)] + [(50.0, 50.0), (None, 1.0)]
    refs = [(rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(40)]
    expected = []
    for i, (x, y) in enumerate(points):
        hits = [
            j
            for j, (a, b) in enumerate(refs)
            if x is not None and abs(x - a) < X.radius and abs(y - b) < Y.radius
        ]
        expected += [(i, j) for j in hits] or [(i, -1)]
    joined = band_join(left_frame(spark, points), ref_frame(spark, refs), [X, Y])
    got = sorted((r["id"], -1 if r["rid"] is None else r["rid"]) for r in joined.collect())
    assert got == sorted(expected)
    inner = band_join(left_frame(spark, points), ref_frame(spark, refs), [X, Y], "inner")
    assert inner.count() == sum(1 for _, j in expected if j >= 0)


def test_small_reference_set_leaves_rows_in_place(spark):
    left, refs = left_frame(spark, [(0.0, 0.0)] * 5), ref_frame(spark, [(0.0, 0.01)])
    out = nearest(left, refs, X, Y, label="name", tie="rid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_fill_keeps_labels_and_deduplicates(spark, rows):
    df = spark.createDataFrame(
        [("1", "Bronx", 0.0, 0.0), ("2", None, 0.0, 0.0), ("3", None, 9.0, 9.0), ("2", "Later", 0.0, 0.0)],
        "id string, area string, x double, y double",
    )
    refs = ref_frame(spark, [(0.0, 0.01)])
    options = {"ref_label": "name", "tie": "rid"}
    out = fill_from_nearest(df, refs, "area", X, Y, **options)
    assert rows(out, "id", "area") == [("1", "Bronx"), ("2", "Later"), ("2", "r0"), ("3", "Unknown")]
    one = fill_from_nearest(df, refs, "area", X, Y, one_per=["id"], order=["area"], **options)
    assert rows(one, "id", "area") == [("1", "Bronx"), ("2", "r0"), ("3", "Unknown")]
    bare = fill_from_nearest(df, refs, "area", X, Y, default=None, **options)
    assert ("3", None) in rows(bare, "id", "area")


def test_feature_collection(spark, rows, tmp_path):
    file = tmp_path / "areas.json"
    file.write_text(
        """{"type": "FeatureCollection", "features": [
          {"properties": {"borough": "A"}, "geometry": {"coordinates": [[[1.0, 2.0], [3.0, 4.0]]]}},
          {"properties": {"borough": "B"}, "geometry": {"coordinates": []}},
          {"properties": {"borough": "C"}},
          {"properties": {"borough": "D"}, "geometry": {"coordinates": [[]]}}
        ]}"""
    )
    df = read_json(spark, str(file), FEATURE_COLLECTION)
    assert rows(flatten_features(df)) == [
        ("A", 1.0, 2.0),
        ("B", None, None),
        ("C", None, None),
        ("D", None, None),
    ]
