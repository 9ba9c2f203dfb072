"""Band joins and the nearest reference point.

A reference point is eligible for a row when both coordinate differences are
strictly below their radius; among eligible points the smallest straight-line
distance wins, ties going to the smallest ``tie`` value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import all_of
from starloom.operators.joins import keys_match
from starloom.operators.keys import dedupe, first_per_group
from starloom.session import reliable_checkpoint

# Reference sets up to this size may be broadcast as lists per grid cell …
SMALL_REFS = 20_000
# … as long as no cell neighbourhood holds more candidates than this.
SMALL_CELL = 256
# … and the lists take no more than this, labels included.
SMALL_BYTES = 32 << 20
# Larger sets are searched through a hierarchy of grids; each level splits a
# cell into 2**LEVEL_BITS by 2**LEVEL_BITS and the finest ones aim at this many.
LEAF_REFS = 32
LEVEL_BITS = 2
MAX_LEVELS = 12
# Cells are a little wider than the radius, so that rounding in the division
# can never put two points inside one band more than one cell apart.
_WIDEN = 1.0 + 2.0**-20
# Coordinates this many radii out, beyond any map, share the outermost cell: cell
# numbers stay exact and within bigint however fine the grid.
_EDGE = 2.0**31


@dataclass(frozen=True)
class Axis:
    """One coordinate: its name on both sides and the radius of the band."""

    left: str
    ref: str
    radius: float


def _cell(value: Column, radius: float, scale: int = 1) -> Column:
    """Number of the cell, ``scale`` times narrower than the radius.

    Huge and infinite values (NaN too) are in the outermost cells; being in one
    cell makes two points no partners, that is up to the band.
    """
    near = F.greatest(F.lit(-_EDGE), F.least(F.lit(_EDGE), value / F.lit(radius * _WIDEN)))
    return F.floor(near * F.lit(float(scale))).cast("bigint")


def _around(c: Column) -> Column:
    return F.explode(F.array(c - 1, c, c + 1))


def band_join(left: DataFrame, refs: DataFrame, axes: Sequence[Axis], how: str = "left") -> DataFrame:
    """All pairs inside the band, as a hash join on grid cells.

    References are repeated in the neighbouring cells, rows sit in their own;
    the band is part of the join condition so that left rows without a partner
    stay exactly once.  The result holds every pair by definition: use
    ``nearest`` when only the closest one is wanted.
    """
    grid = refs
    for i, a in enumerate(axes):
        grid = grid.withColumn(f"_ref_cell{i}", _around(_cell(F.col(a.ref), a.radius)))
    cells = left.withColumns(
        {f"_cell{i}": _cell(F.col(a.left), a.radius) for i, a in enumerate(axes)}
    )
    match = all_of(
        cond
        for i, a in enumerate(axes)
        for cond in (
            F.col(f"_cell{i}") == F.col(f"_ref_cell{i}"),
            F.abs(F.col(a.left) - F.col(a.ref)) < a.radius,
        )
    )
    return cells.join(grid, match, how).select(*left.columns, *refs.columns)


def _square_distance(x1: Column, x2: Column, y1: Column, y2: Column) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def _points(refs: DataFrame, x: Axis, y: Axis, label: str, tie: str) -> DataFrame:
    """References as ``(_rx, _ry, _tie, _label)``, one per place.

    Of several references at one place only the smallest tie can win.  Those at
    no finite place are within no band.
    """
    finite = [F.abs(F.col(a.ref).cast("double")) < float("inf") for a in (x, y)]
    rows = refs.where(all_of(finite)).select(
        F.col(x.ref).cast("double").alias("_rx"),
        F.col(y.ref).cast("double").alias("_ry"),
        F.col(tie).alias("_tie"),
        F.col(label).alias("_label"),
    )
    return first_per_group(rows, ["_rx", "_ry"], ["_tie", "_label"])


def _flat(left: DataFrame, points: DataFrame, x: Axis, y: Axis) -> DataFrame:
    """Small reference set: one broadcast row per cell listing its candidates.

    Every left row meets exactly one cell row and is never shuffled.
    """
    lists = (
        points.select(
            "*",
            _around(_cell(F.col("_rx"), x.radius)).alias("_i"),
        )
        .select("*", _around(_cell(F.col("_ry"), y.radius)).alias("_j"))
        .groupBy("_i", "_j")
        .agg(F.collect_list(F.struct("_rx", "_ry", "_tie", "_label")).alias("_near"))
    )
    px, py = F.col(x.left).cast("double"), F.col(y.left).cast("double")
    eligible = F.filter(
        "_near",
        lambda r: (F.abs(px - r["_rx"]) < x.radius) & (F.abs(py - r["_ry"]) < y.radius),
    )
    ranked = F.transform(
        eligible,
        lambda r: F.struct(
            _square_distance(px, r["_rx"], py, r["_ry"]).alias("d2"),
            r["_tie"].alias("tie"),
            r["_label"].alias("label"),
        ),
    )
    rows = left.withColumns({"_pi": _cell(px, x.radius), "_pj": _cell(py, y.radius)})
    return rows.join(
        F.broadcast(lists),
        (F.col("_pi") == F.col("_i")) & (F.col("_pj") == F.col("_j")),
        "left",
    ).select(*left.columns, F.array_min(ranked).alias("_best"))


def _boxes(points: DataFrame, level: int, levels: int) -> DataFrame:
    """Bounding box of the references in every non-empty cell of a level."""
    shift = LEVEL_BITS * (levels - level)
    return points.groupBy(
        F.shiftright("_fi", shift).alias("_i"), F.shiftright("_fj", shift).alias("_j")
    ).agg(
        F.min("_rx").alias("_x0"),
        F.max("_rx").alias("_x1"),
        F.min("_ry").alias("_y0"),
        F.max("_ry").alias("_y1"),
    )


def _step_down(cells: DataFrame, boxes: DataFrame, bits: int = 0) -> DataFrame:
    """Replace each place's cells by the boxes inside them, ``bits`` finer."""
    boxes = boxes.withColumns(
        {"_up_i": F.shiftright("_i", bits), "_up_j": F.shiftright("_j", bits)}
    )
    cells = cells.select("_px", "_py", F.col("_i").alias("_at_i"), F.col("_j").alias("_at_j"))
    match = keys_match(cells, [("_at_i", "_up_i"), ("_at_j", "_up_j")])
    return cells.join(boxes, match).drop("_at_i", "_at_j", "_up_i", "_up_j")


def _prune(frame: DataFrame, x: Axis, y: Axis) -> DataFrame:
    """Keep, per place, the cells that may hold its nearest reference.

    A box out of the band goes; so does one whose nearest corner is farther
    than the farthest corner of a box lying wholly inside the band.
    """
    px, py = F.col("_px"), F.col("_py")
    zero = F.lit(0.0)
    near_x = F.greatest(F.col("_x0") - px, px - F.col("_x1"), zero)
    near_y = F.greatest(F.col("_y0") - py, py - F.col("_y1"), zero)
    far_x = F.greatest(F.abs(px - F.col("_x0")), F.abs(px - F.col("_x1")))
    far_y = F.greatest(F.abs(py - F.col("_y0")), F.abs(py - F.col("_y1")))
    bound = F.when(
        (far_x < x.radius) & (far_y < y.radius), far_x * far_x + far_y * far_y
    )
    limit = F.min("_high").over(Window.partitionBy("_px", "_py"))
    return (
        frame.where((near_x < x.radius) & (near_y < y.radius))
        .select("_px", "_py", "_i", "_j", (near_x * near_x + near_y * near_y).alias("_low"), bound.alias("_high"))
        .withColumn("_limit", limit)
        .where("_limit is null or _low <= _limit")
        .select("_px", "_py", "_i", "_j")
    )


def _depth(points: DataFrame, x: Axis, y: Axis) -> int:
    """Number of levels until no cell holds more than LEAF_REFS references."""
    levels = 0
    while levels < MAX_LEVELS:
        scale = 2 ** (LEVEL_BITS * levels)
        fullest = (
            points.groupBy(
                _cell(F.col("_rx"), x.radius, scale), _cell(F.col("_ry"), y.radius, scale)
            )
            .count()
            .agg(F.max("count"))
            .first()[0]
        )
        if fullest is None or fullest <= LEAF_REFS:
            break
        # Evenly spread references would need this many more levels.
        levels += max(1, math.ceil(math.log(fullest / LEAF_REFS, 4**LEVEL_BITS)))
    return min(levels, MAX_LEVELS)


def _hierarchical(left: DataFrame, points: DataFrame, x: Axis, y: Axis) -> DataFrame:
    """Large reference set: descend from coarse cells to fine ones.

    Works on the distinct places of ``left``, so a place shared by a third of
    the rows is searched once.  Each level keeps only the cells that can still
    hold the nearest reference, and only the finest cells are compared point by
    point.  All joins are equi-joins on cell numbers.  Rows without a place take
    no part and are not shuffled.
    """
    levels = _depth(points, x, y)
    scale = 2 ** (LEVEL_BITS * levels)
    points = points.withColumns(
        {
            "_fi": _cell(F.col("_rx"), x.radius, scale),
            "_fj": _cell(F.col("_ry"), y.radius, scale),
        }
    )
    rows = left.withColumns(
        {"_x": F.col(x.left).cast("double"), "_y": F.col(y.left).cast("double")}
    )
    placed = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    places = rows.where(placed).select(F.col("_x").alias("_px"), F.col("_y").alias("_py")).distinct()
    shift = LEVEL_BITS * levels
    own_i = F.shiftright(_cell(F.col("_px"), x.radius, scale), shift)
    own_j = F.shiftright(_cell(F.col("_py"), y.radius, scale), shift)
    cells = places.select("_px", "_py", _around(own_i).alias("_i"), own_j.alias("_own_j")).select(
        "_px", "_py", "_i", _around(F.col("_own_j")).alias("_j")
    )
    cells = _prune(_step_down(cells, _boxes(points, 0, levels)), x, y)
    for level in range(1, levels + 1):
        boxes = _boxes(points, level, levels)
        cells = _prune(_step_down(cells, boxes, LEVEL_BITS), x, y)
    candidates = cells.join(
        points, (F.col("_i") == F.col("_fi")) & (F.col("_j") == F.col("_fj"))
    ).where(
        (F.abs(F.col("_px") - F.col("_rx")) < x.radius)
        & (F.abs(F.col("_py") - F.col("_ry")) < y.radius)
    )
    best = candidates.groupBy("_px", "_py").agg(
        F.min(
            F.struct(
                _square_distance(
                    F.col("_px"), F.col("_rx"), F.col("_py"), F.col("_ry")
                ).alias("d2"),
                F.col("_tie").alias("tie"),
                F.col("_label").alias("label"),
            )
        ).alias("_best")
    )
    match = keys_match(rows, [("_x", "_px"), ("_y", "_py")])
    found = rows.where(placed).join(best, match, "left").select(*left.columns, "_best")
    nowhere = rows.where(~placed).select(
        *left.columns, F.lit(None).cast(best.schema["_best"].dataType).alias("_best")
    )
    return found.unionByName(nowhere)


def nearest(
    left: DataFrame,
    refs: DataFrame,
    x: Axis,
    y: Axis,
    *,
    label: str,
    tie: str,
    out: str = "nearest",
    small_refs: int = SMALL_REFS,
) -> DataFrame:
    """Every row of ``left`` once, with the label of its nearest reference as
    ``out`` and the distance as ``distance``; both NULL when none is in range.

    The size of the reference set is measured first, in rows and bytes, and
    decides between a broadcast of candidate lists and the search through nested
    grids; the result is the same.
    """
    points = reliable_checkpoint(_points(refs, x, y, label, tie))
    wide = [F.octet_length(F.col(c).cast("string")) for c in ("_tie", "_label")]
    size = (
        points.groupBy(_cell(F.col("_rx"), x.radius), _cell(F.col("_ry"), y.radius))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum(sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(48))).alias("bytes"),
        )
        .agg(
            F.sum("count").alias("rows"), F.max("count").alias("fullest"), F.sum("bytes").alias("bytes")
        )
        .first()
    )
    rows, fullest, taken = (size[c] or 0 for c in ("rows", "fullest", "bytes"))
    small = rows <= small_refs and 9 * fullest <= SMALL_CELL and 9 * taken <= SMALL_BYTES
    best = (_flat if small else _hierarchical)(left, points, x, y)
    return best.select(
        *left.columns,
        F.col("_best.label").alias(out),
        F.sqrt("_best.d2").alias("distance"),
    )


def fill_from_nearest(
    df: DataFrame,
    refs: DataFrame,
    label: str,
    x: Axis,
    y: Axis,
    *,
    ref_label: str,
    tie: str,
    default: str | None = "Unknown",
    one_per: Sequence[str] | None = None,
    order: Sequence[str | Column] | None = None,
    small_refs: int = SMALL_REFS,
) -> DataFrame:
    """Fill missing ``label`` values from the nearest reference, else ``default``.

    Rows that already carry a label keep it.  ``one_per`` additionally keeps a
    single row per key (the first in ``order``), as a nearest-match window
    partitioned by that key does.
    """
    rows = df if one_per is None else dedupe(df, one_per, order)
    # Only rows without a label take part in the search.
    missing = F.col(label).isNull()
    search = rows.withColumns(
        {"_sx": F.when(missing, F.col(x.left)), "_sy": F.when(missing, F.col(y.left))}
    )
    found = nearest(
        search,
        refs,
        Axis("_sx", x.ref, x.radius),
        Axis("_sy", y.ref, y.radius),
        label=ref_label,
        tie=tie,
        out="_found",
        small_refs=small_refs,
    )
    parts = [F.col(label), F.col("_found")]
    if default is not None:
        parts.append(F.lit(default))
    return found.select(
        *[(F.coalesce(*parts).alias(c) if c == label else F.col(c)) for c in df.columns]
    )
