"""Plane geometry on columns: points are pairs of columns, curves pairs of arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cytoframe.functions.vectors import places


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x2 - x1, y2 - y1)


def orientation_sign(x1, y1, x2, y2, px, py) -> Column:
    """On which side of a directed line a point lies: 1 left, -1 right, 0 on it."""
    return F.signum((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1))


def intersect_lines(x1, y1, x2, y2, x3, y3, x4, y4) -> Column:
    """Where two lines through two points each meet; null for parallels."""
    det = (x1 - x2) * (y3 - y4) - (y1 - y2) * (x3 - x4)
    a, b = x1 * y2 - y1 * x2, x3 * y4 - y3 * x4
    return F.when(det != 0, F.struct(((a * (x3 - x4) - (x1 - x2) * b) / det).alias("x"), ((a * (y3 - y4) - (y1 - y2) * b) / det).alias("y")))


def angle_between(ax, ay, bx, by) -> Column:
    cosine = F.try_divide(ax * bx + ay * by, F.hypot(ax, ay) * F.hypot(bx, by))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def polyline_length(xs: Column, ys: Column, unit: float = 1.0) -> Column:
    steps = F.transform(places(xs), lambda i: F.when(i > 0, F.hypot(F.get(xs, i) - F.get(xs, i - 1), F.get(ys, i) - F.get(ys, i - 1))).otherwise(F.lit(0.0)))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) * unit


def sinuosity(xs: Column, ys: Column) -> Column:
    """Length over the distance of the ends, three decimals, one at least; an error for closed curves."""
    chord = F.hypot(F.element_at(xs, -1) - F.get(xs, F.lit(0)), F.element_at(ys, -1) - F.get(ys, F.lit(0)))
    value = F.greatest(F.lit(1.0), F.round(polyline_length(xs, ys) / chord, 3))
    return F.when(chord > 0, value).otherwise(F.raise_error(F.lit("a closed curve has no sinuosity")))


def _turn(xs: Column, ys: Column, i: Column, before: Column, after: Column, degrees: bool) -> Column:
    a = F.atan2(F.get(ys, i) - F.get(ys, before), F.get(xs, i) - F.get(xs, before))
    b = F.atan2(F.get(ys, after) - F.get(ys, i), F.get(xs, after) - F.get(xs, i))
    turn = b - a
    turn = F.when(turn > math.pi, turn - 2 * math.pi).when(turn < -math.pi, turn + 2 * math.pi).otherwise(turn)
    return F.degrees(turn) if degrees else turn


def bend_angles(xs: Column, ys: Column, window: int = 1, closed: bool = False, degrees: bool = True) -> Column:
    """Turning angles between chords of ``window`` steps; open curves lose the ends."""
    n = F.size(xs)
    if closed:
        return F.transform(places(xs), lambda i: _turn(xs, ys, i, F.pmod(i - window, n), F.pmod(i + window, n), degrees))
    inner = F.when(n > 2 * window, F.sequence(F.lit(window), n - 1 - window)).otherwise(F.array().cast("array<int>"))
    return F.transform(inner, lambda i: _turn(xs, ys, i, i - window, i + window, degrees))


def unit_normals(xs: Column, ys: Column, closed: bool = False) -> Column:
    """A unit normal at each point, across the step to it; the first is its neighbour's, or wraps."""

    def at(i: Column) -> Column:
        j = F.when(i > 0, i).otherwise(F.lit(0) if closed else F.lit(1))
        k = F.pmod(j - 1, F.size(xs))
        dx, dy = F.get(xs, j) - F.get(xs, k), F.get(ys, j) - F.get(ys, k)
        return F.struct(F.try_divide(-dy, F.hypot(dx, dy)).alias("x"), F.try_divide(dx, F.hypot(dx, dy)).alias("y"))

    return F.transform(places(xs), at)


def line_crossings(p1, p2, xs: Column, ys: Column) -> Column:
    """Where the line through two points crosses a closed curve's edges."""

    def edge(i: Column) -> Column:
        j = F.pmod(i + 1, F.size(xs))
        ex, ey = F.get(xs, j) - F.get(xs, i), F.get(ys, j) - F.get(ys, i)
        dx, dy = p2[0] - p1[0], p2[1] - p1[1]
        det = dx * ey - dy * ex
        t = F.try_divide(dy * (F.get(xs, i) - p1[0]) - dx * (F.get(ys, i) - p1[1]), det)
        return F.when((t >= 0) & (t < 1), F.struct((F.get(xs, i) + t * ex).alias("x"), (F.get(ys, i) + t * ey).alias("y")))

    return F.filter(F.transform(places(xs), edge), lambda p: p.isNotNull())


def touching_edge(rows, cols, r1, c1, r2, c2, margin: float = 0) -> Column:
    """Whether a closed box comes within ``margin`` of the image's border."""
    return F.least(r1, c1, rows - r2 - 1, cols - c2 - 1) <= margin


def padded_box(rows, cols, r1, c1, r2, c2, width: int) -> Column:
    """A box grown by ``width`` and cut at the border; touching if a side lies within half of it."""
    zero = F.lit(0)
    return F.struct(
        F.greatest(zero, r1 - width).alias("r1"), F.greatest(zero, c1 - width).alias("c1"), F.least(rows - 1, r2 + width).alias("r2"), F.least(cols - 1, c2 + width).alias("c2"),
        touching_edge(rows, cols, r1, c1, r2, c2, 0.5 * width).alias("touching"),
    )


def crop_window(r1, c1, r2, c2, centre_row, centre_col, size: int, pad: int) -> Column:
    """A square around the centroid, or around the box where there is none, as large as the box asks for."""
    side = F.greatest(F.lit(size), (r2 - r1) + 2 * pad, (c2 - c1) + 2 * pad)
    cy = F.bround(F.coalesce(F.nanvl(centre_row, F.lit(None)), (r1 + r2) / 2), 0).cast("int")
    cx = F.bround(F.coalesce(F.nanvl(centre_col, F.lit(None)), (c1 + c2) / 2), 0).cast("int")
    half = F.floor(side / 2).cast("int")
    return F.struct((cy - half).alias("y0"), (cy - half + side).alias("y1"), (cx - half).alias("x0"), (cx - half + side).alias("x1"))


def flat_page(axes: str, sizes: dict[str, int], at: dict[str, int]) -> int:
    """The page of a plane in a stack whose axes, slowest first, are a string such as ``TZCYX``."""
    page = 0
    for axis in axes:
        if axis in "YXS":
            continue
        if not 0 <= at.get(axis, 0) < sizes[axis]:
            raise IndexError(f"axis {axis} has {sizes[axis]} planes, not {at.get(axis, 0)}")
        page = page * sizes[axis] + at.get(axis, 0)
    return page


def imagej_fields(info: Column) -> Column:
    """``key = value`` lines of an image's description as a map."""
    lines = F.filter(F.split(info, "\n"), lambda line: F.contains(line, F.lit(" = ")))
    return F.map_from_entries(F.transform(lines, lambda line: F.struct(F.trim(F.substring_index(line, " = ", 1)), F.trim(F.regexp_replace(line, "^.*? = ", "")))))
