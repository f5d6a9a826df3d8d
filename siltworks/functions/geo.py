"""Geometry as text: boxes, envelopes, polygons, reference systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bbox_wkt(west: Column, south: Column, east: Column, north: Column) -> Column:
    """The closed ring of a box; '' if a bound is missing. Zero is a valid bound."""
    w, s, e, n = (c.cast("string") for c in (west, south, east, north))
    ring = F.concat(F.lit("POLYGON (("), F.concat_ws(",", *[F.concat_ws(" ", x, y) for x, y in ((w, s), (w, n), (e, n), (e, s), (w, s))]), F.lit("))"))
    there = w.isNotNull() & s.isNotNull() & e.isNotNull() & n.isNotNull()
    return F.when(there, ring).otherwise("")


def epsg(c: Column) -> Column:
    """A reference system's EPSG name; '' if it has none."""
    low = F.lower(c)
    return (
        F.when(low.startswith("epsg:"), c)
        .when(c.startswith("urn:ogc:def:crs:EPSG"), F.concat(F.lit("EPSG:"), F.substring_index(c, ":", -1)))
        .when(low.isin("crs:84", "urn:ogc:def:crs:ogc:1.3:crs84"), "EPSG:4326")
        .otherwise("")
    )


def reprojected(wkt: Column, srs: Column) -> Column:
    """The geometry in EPSG:4326: as it is if it lies there, else null, as no projections are at hand."""
    return F.when(epsg(F.coalesce(srs, F.lit("EPSG:4326"))) == "EPSG:4326", wkt)


def gml_polygon(positions: Column) -> Column:
    """A ring from gml:pos or posList texts in the order they stand, closed if open."""
    nums = F.filter(F.split(F.array_join(positions, " "), r"[\s,]+"), lambda x: x != "")
    pts = F.transform(F.sequence(F.lit(0), F.floor(F.size(nums) / 2).cast("int") - 1), lambda i: F.concat_ws(" ", F.get(nums, i * 2), F.get(nums, i * 2 + 1)))
    closed = F.when(F.get(pts, F.lit(0)) == F.element_at(pts, -1), pts).otherwise(F.concat(pts, F.slice(pts, 1, 1)))
    return F.when(F.size(nums) >= 6, F.concat(F.lit("POLYGON (("), F.array_join(closed, ","), F.lit("))"))).otherwise("")


def gml_envelope(positions: Column) -> Column:
    """[minx, miny, maxx, maxy] of two positions; null if there are not two."""
    nums = F.transform(F.filter(F.split(F.array_join(F.slice(positions, 1, 2), " "), r"\s+"), lambda x: x != ""), lambda x: x.try_cast("double"))
    return F.when((F.size(positions) >= 2) & (F.size(nums) == 4), nums)
