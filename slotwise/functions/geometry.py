"""Bounding-box, matrix and region expressions over struct and array columns.

A box is ``struct<x1,y1,x2,y2>``; a matrix is a row-major array of nine doubles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the 3x3 regions and of the frame sides.
REGION_ROWS = ("top", "middle", "bottom")
REGION_COLUMNS = ("left", "center", "right")


def box(x1, y1, x2, y2) -> Column:
    return F.struct(
        F.lit(x1).alias("x1") if not isinstance(x1, Column) else x1.alias("x1"),
        F.lit(y1).alias("y1") if not isinstance(y1, Column) else y1.alias("y1"),
        F.lit(x2).alias("x2") if not isinstance(x2, Column) else x2.alias("x2"),
        F.lit(y2).alias("y2") if not isinstance(y2, Column) else y2.alias("y2"),
    )


def project_point(m: Column, x: Column, y: Column) -> tuple[Column, Column]:
    w = m[6] * x + m[7] * y + m[8]
    return (m[0] * x + m[1] * y + m[2]) / w, (m[3] * x + m[4] * y + m[5]) / w


def project_bbox(m: Column, b: Column) -> Column:
    """Axis-aligned hull of the four projected corners."""
    corners = [(b["x1"], b["y1"]), (b["x2"], b["y1"]), (b["x2"], b["y2"]), (b["x1"], b["y2"])]
    points = [project_point(m, x, y) for x, y in corners]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return box(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))


def compose_matrix(a: Column, b: Column) -> Column:
    """3x3 product, row major; written as one lambda so that the plan stays small."""

    def entry(i: Column) -> Column:
        row, column = (i - i % 3).cast("int"), (i % 3).cast("int")
        return reduce(lambda s, t: s + t, [a[row + k] * b[column + 3 * k] for k in range(3)])

    return F.transform(F.sequence(F.lit(0), F.lit(8)), entry)


def crop_matrix(camera_x, camera_y, camera_w, camera_h, out_w, out_h) -> Column:
    """Maps a camera window of the scene to the output frame."""
    sx, sy = out_w / camera_w, out_h / camera_h
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(sx, zero, -camera_x * sx, zero, sy, -camera_y * sy, zero, zero, one)


def translation_matrix(dx: Column, dy: Column) -> Column:
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(one, zero, dx, zero, one, dy, zero, zero, one)


def quad_gate(points: list[tuple[Column, Column]], canvas_area, min_fraction: float) -> Column:
    """Convexity and area test of a quadrilateral given by its corners in order."""
    turns = []
    for i in range(4):
        (ax, ay), (bx, by), (cx, cy) = points[i], points[(i + 1) % 4], points[(i + 2) % 4]
        turns.append((bx - ax) * (cy - by) - (by - ay) * (cx - bx))
    convex = (F.least(*turns) >= 0) | (F.greatest(*turns) <= 0)
    shoelace = reduce(
        lambda s, t: s + t,
        [
            points[i][0] * points[(i + 1) % 4][1] - points[(i + 1) % 4][0] * points[i][1]
            for i in range(4)
        ],
    )
    fraction = F.abs(shoelace) * 0.5 / canvas_area
    reason = F.when(~convex, F.lit("not_convex")).when(fraction < min_fraction, F.lit("area_below_minimum"))
    return F.struct(reason.isNull().alias("ok"), fraction.alias("area_fraction"), reason.alias("reason"))


def intersects(a: Column, b: Column) -> Column:
    """True when the interiors meet; touching edges do not count."""
    return (a["x2"] > b["x1"]) & (b["x2"] > a["x1"]) & (a["y2"] > b["y1"]) & (b["y2"] > a["y1"])


def clip(b: Column, width, height) -> Column:
    """Box limited to the frame, NULL when nothing is left."""

    def limit(value: Column, top) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(top), value))

    c = box(limit(b["x1"], width), limit(b["y1"], height), limit(b["x2"], width), limit(b["y2"], height))
    return F.when((c["x2"] > c["x1"]) & (c["y2"] > c["y1"]), c)


def expand(b: Column, amount) -> Column:
    return box(b["x1"] - amount, b["y1"] - amount, b["x2"] + amount, b["y2"] + amount)


def area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def normalized_bbox(b: Column, width, height) -> Column:
    """Centre and size as fractions of the frame."""
    return F.struct(
        ((b["x1"] + b["x2"]) / 2.0 / width).alias("cx"),
        ((b["y1"] + b["y2"]) / 2.0 / height).alias("cy"),
        ((b["x2"] - b["x1"]) / F.lit(float(width))).alias("w"),
        ((b["y2"] - b["y1"]) / F.lit(float(height))).alias("h"),
    )


def visible_fraction_gate(full: Column, clipped: Column, minimum: float, has_alpha: Column | None = None) -> Column:
    """Visible share of a box and the typed reason when it must be rejected."""
    visibility = F.when(clipped.isNull(), 0.0).otherwise(
        F.least(F.lit(1.0), area(clipped) / F.greatest(F.lit(1e-9), area(full)))
    )
    reason = F.when(clipped.isNull(), F.lit("outside_frame")).when(
        visibility < minimum, F.lit("visible_bbox_fraction")
    )
    if has_alpha is not None:
        reason = F.when(~has_alpha, F.lit("empty_alpha")).otherwise(reason)
    return F.struct(visibility.alias("visibility"), reason.alias("reason"))


def spatial_region(x: Column, y: Column, width, height) -> Column:
    """One of nine labels such as ``top-left``; points outside are clamped."""

    def third(value: Column, size) -> Column:
        size = size if isinstance(size, Column) else F.lit(float(size))
        cell = F.floor(value / F.greatest(size.cast("double"), F.lit(1.0)) * 3)
        return F.least(F.lit(2), F.greatest(F.lit(0), cell)).cast("int")

    rows = F.array(*[F.lit(name) for name in REGION_ROWS])
    columns = F.array(*[F.lit(name) for name in REGION_COLUMNS])
    return F.concat(rows[third(y, height)], F.lit("-"), columns[third(x, width)])


def clipped_sides(b: Column, width, height) -> Column:
    """Names of the frame sides the box reaches past, in fixed order."""
    return F.array_compact(
        F.array(
            F.when(b["x1"] < 0, F.lit("left")),
            F.when(b["y1"] < 0, F.lit("top")),
            F.when(b["x2"] > width, F.lit("right")),
            F.when(b["y2"] > height, F.lit("bottom")),
        )
    )


def histogram_bin(x: Column, y: Column, bins: int) -> Column:
    """Row-major cell of a normalised point in a bins x bins grid, clamped."""
    if not 1 <= bins <= 16:
        raise ValueError("bins must be between 1 and 16")

    def cell(value: Column) -> Column:
        return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(value * bins)))

    return (cell(y) * bins + cell(x)).cast("int")


def scale_step(value: Column) -> Column:
    """Number of the 0.1 wide band of a scale, never below 0."""
    return F.greatest(F.lit(0).cast("bigint"), F.floor(value * 10))


def rotation_step(value: Column) -> Column:
    """Number of the 15 degree band of the absolute angle modulo 180."""
    return F.floor(F.abs(value) % 180 / 15).cast("bigint")


def scale_band_text(step: Column) -> Column:
    return F.format_string("%.2f-%.2f", step / 10, step / 10 + 0.1)


def rotation_band_text(step: Column) -> Column:
    return F.format_string("%d-%d", step * 15, step * 15 + 15)


def scale_band(value: Column) -> Column:
    """Text band of width 0.1, for example ``0.20-0.30``."""
    return scale_band_text(scale_step(value))


def rotation_band(value: Column) -> Column:
    """Text band of 15 degrees of the absolute angle modulo 180, for example ``30-45``."""
    return rotation_band_text(rotation_step(value))
