"""Vertex arrays: ``array<struct<lat double, lng double>>`` (ARR-1, ARR-2, ARR-4, AGG-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_col


def close_ring(ring) -> Column:
    """ARR-1: append the first vertex so the outline is closed."""
    r = as_col(ring)
    return F.concat(r, F.slice(r, 1, 1))


def first_loop(polygons) -> Column:
    """ARR-2: polygons (array of arrays of loops) -> loops flattened -> the first one."""
    return F.get(F.flatten(as_col(polygons)), 0)


def ring_centroid(ring) -> Column:
    """ARR-4: centroid of a closed ring, as struct(lat, lng).

    A polygon has its area centroid (shoelace; x = lng, y = lat).  Without area a line has
    the middle of its length, and a point (one vertex, or the same one repeated) is its
    own centre.  A null or empty ring gives null.
    """
    r = as_col(ring)
    n = F.size(r)
    idx = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))

    o = F.get(r, 0)  # measured from the first vertex: small outlines far from 0 keep their digits

    def at(i, axis):
        return F.element_at(r, i)[axis] - o[axis]

    def cross(i):
        return at(i, "lng") * at(i + 1, "lat") - at(i + 1, "lng") * at(i, "lat")

    def sum_over(fn):
        return F.aggregate(idx, F.lit(0.0), lambda acc, i: acc + fn(i))

    area2 = sum_over(cross)
    cx = sum_over(lambda i: (at(i, "lng") + at(i + 1, "lng")) * cross(i))
    cy = sum_over(lambda i: (at(i, "lat") + at(i + 1, "lat")) * cross(i))

    def step(i):
        lat, lng = at(i, "lat") - at(i + 1, "lat"), at(i, "lng") - at(i + 1, "lng")
        return F.sqrt(lat * lat + lng * lng)

    length = sum_over(step)

    def middle(axis):
        halves = sum_over(lambda i: step(i) * (at(i, axis) + at(i + 1, axis)) / 2.0)
        return F.coalesce(F.try_divide(halves, length), F.lit(0.0))

    def centre(moment, axis):
        return o[axis] + F.when(area2 != 0, F.try_divide(moment, area2 * 3.0)).otherwise(middle(axis))

    return F.when(n > 0, F.struct(centre(cy, "lat").alias("lat"), centre(cx, "lng").alias("lng")))
