"""Nearest place by great-circle distance over a quadtree of the globe.

Places lie in latitude-longitude cells that halve in both directions until a
cell holds at most ``CELL_PLACES`` distinct coordinates, so a dense region is
many small cells and an empty one few. Every cell keeps one of its places,
whose distance bounds the nearest distance from above; from below a cell is
bounded by the latitudes between it and the point and by the distance to its
nearest meridian, with longitudes taken around the globe, so the date line and
the poles need no special care.

All points descend together, a level a step: the cells that a point still has
are joined with their children, the point's bound is the least distance to any
kept place so far, and children that lie farther than it go. The places of the
remaining leaves are compared exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

EARTH_KM = 6371.0
CELL_PLACES = 64
MAX_LEVEL = 24
DIST_DIGITS = 6
SLACK_KM = 1e-5


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = p2 - p1, F.radians(lng2) - F.radians(lng1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _cell(lat: str, lng: str) -> list[Column]:
    """Cell numbers at ``MAX_LEVEL``: two cells around the globe at level 0."""
    n = 1 << MAX_LEVEL
    x = F.pmod(F.floor((F.col(lng) + 180) * (n / 180)), F.lit(2 * n))
    y = F.least(F.greatest(F.floor((F.col(lat) + 90) * (n / 180)), F.lit(0)), F.lit(n - 1))
    return [x.cast("long").alias("x"), y.cast("long").alias("y")]


def cells_of(places: DataFrame, cell_places: int = CELL_PLACES) -> tuple[DataFrame, DataFrame, int]:
    """(cells, leaves, deepest level). ``places``: glat, glng, place, x, y with
    distinct coordinates. ``cells``: level, cx, cy, leaf, rlat, rlng;
    ``leaves``: level, cx, cy, place, glat, glng."""
    rest, cells, leaves, level = places, None, None, 0
    key = ["level", "cx", "cy"]
    while True:
        at = lambda c: F.shiftright(c, MAX_LEVEL - level)  # noqa: E731, B023
        named = rest.withColumns({"level": F.lit(level), "cx": at("x"), "cy": at("y")})
        here = cut_lineage(named.groupBy(*key).agg(
            (F.count(F.lit(1)) <= (cell_places if level < MAX_LEVEL else 1 << 62)).alias("leaf"),
            F.min(F.struct("glat", "glng")).alias("r")).select(*key, "leaf", F.col("r.glat").alias("rlat"), F.col("r.glng").alias("rlng")))
        inside = named.join(here.where("leaf").select(*key), key).select(*key, "place", "glat", "glng")
        cells, leaves = (here, inside) if cells is None else (cells.unionByName(here), leaves.unionByName(inside))
        if not here.where("not leaf").take(1):
            return cut_lineage(cells), cut_lineage(leaves), level
        rest = cut_lineage(named.join(here.where("not leaf").select(*key), key).drop(*key))
        level += 1


def _lower_bound(lat: Column, lng: Column, level: Column, cx: Column, cy: Column) -> Column:
    """Kilometres that no place of the cell can be nearer than."""
    size = F.lit(180.0) / F.pow(F.lit(2.0), level)
    south, west = cy * size - 90, cx * size - 180
    up = F.greatest(south - lat, lat - (south + size), F.lit(0.0))
    east = F.pmod(lng - west, F.lit(360.0))  # degrees from the west edge, eastward
    around = F.when(east <= size, 0.0).otherwise(F.least(east - size, 360 - east))
    across = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(F.least(around, F.lit(90.0)))))
    return F.lit(EARTH_KM) * F.greatest(F.radians(up), across)


def geocode_reverse(points: DataFrame, lat: str, lng: str, gazetteer: DataFrame, name: str = "name",
                    glat: str = "lat", glng: str = "lng", cell_places: int = CELL_PLACES) -> DataFrame:
    """Nearest gazetteer place by great-circle distance (rounded distance,
    then name, decide ties). Adds ``place`` and ``distance_km``; every point
    row gives one row, repeated ones too; a point without coordinates, or an
    empty gazetteer, gives nulls; places without coordinates are never found."""
    where = gazetteer.select(F.col(name).alias("place"), F.col(glat).cast("double").alias("glat"),
                             F.col(glng).cast("double").alias("glng")).where("glat is not null and glng is not null")
    places = cut_lineage(where.groupBy("glat", "glng").agg(F.min("place").alias("place")).select(
        "place", "glat", "glng", *_cell("glat", "glng")))
    # the row number is fixed by a checkpoint, so every step sees the same one
    pts = cut_lineage(points.withColumn("_rid", F.monotonically_increasing_id()))
    at = pts.select("_rid", F.col(lat).cast("double").alias("_lat"), F.col(lng).cast("double").alias("_lng")).where(
        "_lat is not null and _lng is not null")
    cells, leaves, deepest = cells_of(places, cell_places)
    kept = candidate_leaves(at, cells, deepest)
    d = F.round(haversine_km(F.col("_lat"), F.col("_lng"), F.col("glat"), F.col("glng")), DIST_DIGITS)
    best = kept.join(leaves, ["level", "cx", "cy"]).groupBy("_rid").agg(F.min(F.struct(d.alias("d"), "place")).alias("_b"))
    return pts.join(best, "_rid", "left").select(
        *points.columns, F.col("_b.place").alias("place"), F.col("_b.d").alias("distance_km"))


def candidate_leaves(at: DataFrame, cells: DataFrame, deepest: int) -> DataFrame:
    """``(_rid, _lat, _lng, level, cx, cy)``: the leaves that may hold the
    nearest place of each point."""
    top = cells.where("level = 0")
    # level 0 has two cells; a constant key keeps it an equi-join
    open_ = at.withColumn("cx", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")))).withColumn(
        "cy", F.lit(0).cast("long")).join(top, ["cx", "cy"])
    done = None
    for level in range(deepest + 1):
        seen = cut_lineage(open_.withColumns({
            "low": _lower_bound(F.col("_lat"), F.col("_lng"), F.col("level"), F.col("cx"), F.col("cy")),
            "high": haversine_km(F.col("_lat"), F.col("_lng"), F.col("rlat"), F.col("rlng"))}))
        least = seen.groupBy("_rid").agg(F.min("high").alias("m"))
        if done is not None:
            least = least.unionByName(bound).groupBy("_rid").agg(F.min("m").alias("m"))  # noqa: F821
        bound = cut_lineage(least)
        near = seen.join(bound, "_rid").where(F.col("low") <= F.col("m") + SLACK_KM)
        leaf = near.where("leaf").select("_rid", "_lat", "_lng", "level", "cx", "cy", "low")
        done = leaf if done is None else done.unionByName(leaf)
        if level == deepest:
            break
        children = cells.where(F.col("level") == level + 1).withColumns(
            {"px": F.shiftright("cx", 1), "py": F.shiftright("cy", 1)})
        up = near.where(~F.col("leaf")).select("_rid", "_lat", "_lng", F.col("cx").alias("px"), F.col("cy").alias("py"))
        open_ = up.join(children, ["px", "py"]).drop("px", "py")
    return done.join(bound, "_rid").where(F.col("low") <= F.col("m") + SLACK_KM).select("_rid", "_lat", "_lng", "level", "cx", "cy")
