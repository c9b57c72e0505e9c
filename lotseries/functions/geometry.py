"""Affine transforms, rings and rectangles.

A transform is given as the six columns ``a b c d e f`` of
``x = a*col + b*row + c``, ``y = d*col + e*row + f``. A ring is an
``array<struct<x double, y double>>``; it may be open or closed. A polygon is an
array of rings, in any order: outlines of its parts and of their holes. A point lies
in it if it lies in an odd number of them, so parts must not overlap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSFORM = ["a", "b", "c", "d", "e", "f"]


def pixel_center(col: Column, row: Column, t: dict[str, Column]) -> tuple[Column, Column]:
    """World coordinates of the centre of a pixel."""
    u, v = col + F.lit(0.5), row + F.lit(0.5)
    return t["a"] * u + t["b"] * v + t["c"], t["d"] * u + t["e"] * v + t["f"]


def window_transform(t: dict[str, Column], col_off: Column, row_off: Column) -> dict[str, Column]:
    """Transform of a sub-window whose first pixel is (row_off, col_off)."""
    return {
        **t,
        "c": t["a"] * col_off + t["b"] * row_off + t["c"],
        "f": t["d"] * col_off + t["e"] * row_off + t["f"],
    }


def to_pixel(x: Column, y: Column, t: dict[str, Column]) -> tuple[Column, Column]:
    """Fractional (col, row) of a world point: the inverse of the transform."""
    det = t["a"] * t["e"] - t["b"] * t["d"]
    dx, dy = x - t["c"], y - t["f"]
    return (t["e"] * dx - t["b"] * dy) / det, (t["a"] * dy - t["d"] * dx) / det


def world_file(text: Column) -> Column:
    """Transform struct of a world file with the lines a, d, b, e, c, f.

    Null if one of the first six lines is no number, or missing. c and f are used as the corner
    of the first pixel.
    """
    values = _world_lines(text)
    order = ["a", "d", "b", "e", "c", "f"]
    at = {name: F.get(values, F.lit(i)) for i, name in enumerate(order)}
    six = F.slice(values, 1, 6)
    good = (F.size(six) == 6) & ~F.exists(six, lambda v: v.isNull())
    return F.when(good, F.struct(*[at[n].alias(n) for n in TRANSFORM]))


def _world_lines(text: Column) -> Column:
    """The lines of a world file as numbers, null where they are none; blank lines are left out."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n|\r"), lambda s: F.trim(s)), lambda s: s != "")
    return F.transform(lines, lambda s: s.try_cast("double"))


def world_file_broken(text: Column) -> Column:
    """Whether a world file makes its raster unreadable: a line is no number, or there are more than six.

    One with fewer lines is not broken: the raster's own transform is used.
    """
    values = _world_lines(text)
    return F.coalesce((F.size(values) > 6) | F.exists(values, lambda v: v.isNull()), F.lit(False))


def usable_transform(t: dict[str, Column]) -> Column:
    """Whether all six numbers are there and finite, and the transform can be inverted."""
    finite = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))) for c in t.values()]
    known = F.lit(True)
    for one in finite:
        known = known & one
    return F.coalesce(known & (t["a"] * t["e"] - t["b"] * t["d"] != 0), F.lit(False))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring; the last vertex is joined to the first."""
    closed = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        closed,
        lambda p, q: F.struct(
            p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")
        ),
    )


def crosses_line(edge: Column, y: Column) -> Column:
    """Half-open rule: an edge crosses a horizontal line if its ends lie on different sides."""
    return (edge["y1"] > y) != (edge["y2"] > y)


def crossing_x(edge: Column, y: Column) -> Column:
    return edge["x1"] + (y - edge["y1"]) * (edge["x2"] - edge["x1"]) / (edge["y2"] - edge["y1"])


def polygon_of(columns: list[str]) -> Column:
    """The polygon of a row: its column ``rings`` if there is one, else its only ``ring``."""
    return F.col("rings") if "rings" in columns else F.array(F.col("ring"))


def polygon_edges(rings: Column) -> Column:
    """Edges of all rings."""
    return F.flatten(F.transform(rings, ring_edges))


def point_in_polygon(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd test of a point against all rings."""
    right = F.filter(
        polygon_edges(rings), lambda e: crosses_line(e, y) & (x < F.when(crosses_line(e, y), crossing_x(e, y)))
    )
    return F.size(right) % 2 == 1


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    return point_in_polygon(x, y, F.array(ring))


def polygon_bounds(rings: Column) -> dict[str, Column]:
    return ring_bounds(F.flatten(rings))


def ring_bounds(ring: Column) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return {
        "xmin": F.array_min(xs),
        "ymin": F.array_min(ys),
        "xmax": F.array_max(xs),
        "ymax": F.array_max(ys),
    }


def boxes_overlap(p: dict[str, Column], q: dict[str, Column]) -> Column:
    """True if two boxes share at least a point."""
    return (
        (p["xmin"] <= q["xmax"])
        & (p["xmax"] >= q["xmin"])
        & (p["ymin"] <= q["ymax"])
        & (p["ymax"] >= q["ymin"])
    )


def _edge_meets_box(e: Column, box: dict[str, Column]) -> Column:
    edge_box = {
        "xmin": F.least(e["x1"], e["x2"]),
        "xmax": F.greatest(e["x1"], e["x2"]),
        "ymin": F.least(e["y1"], e["y2"]),
        "ymax": F.greatest(e["y1"], e["y2"]),
    }

    def side(x: str, y: str) -> Column:
        return (e["x2"] - e["x1"]) * (box[y] - e["y1"]) - (e["y2"] - e["y1"]) * (box[x] - e["x1"])

    sides = [side(x, y) for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
    # the line through the edge separates the box only if all corners lie on one side
    return boxes_overlap(edge_box, box) & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def polygon_meets_box(rings: Column, box: dict[str, Column]) -> Column:
    """True if a polygon and a box share at least a point.

    Either an edge touches the box, or the box lies inside the polygon.
    """
    touched = F.exists(polygon_edges(rings), lambda e: _edge_meets_box(e, box))
    return touched | point_in_polygon(box["xmin"], box["ymin"], rings)


def ring_meets_box(ring: Column, box: dict[str, Column]) -> Column:
    return polygon_meets_box(F.array(ring), box)
