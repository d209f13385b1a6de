"""Spatial joins: boxes and radii by grid cells, nearest neighbours in growing cells, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.config import DEFAULT
from tidewake.functions.geo import cell, globe_cell, globe_cells, haversine, in_box

#: Rows up to which a place table is sent to every executor and compared in full (about 200 bytes each).
BROADCAST_ROWS = 2_000
#: Kilometres of a degree of arc.
DEGREE_KM = DEFAULT.earth_km * 3.141592653589793 / 180.0


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most ``rows`` rows; at most one more is read from each partition."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def nearest(points: DataFrame, places: DataFrame, key: list[str], place_id: str, lat: str, lon: str, start_degrees: float = 1.0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """key, place_id, km: the nearest place of each point (tie: the lower id); points without a position are left out.

    A small place table is broadcast and compared in full, with a partial ``min``.  A larger one is joined by cells of the globe
    that grow until every point has a place that is certainly the nearest; a round holds only the points that are left.  Both give the same.
    """
    at = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(*key, F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    own = places.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(F.col(place_id).alias("_id"), F.col("latitude").alias("_plat"), F.col("longitude").alias("_plon"))
    km = haversine(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon"))
    best = F.min(F.struct(F.col("_km"), F.col("_id"))).alias("b")
    out = lambda found: found.select(*key, F.col("b._id").alias(place_id), F.col("b._km").alias("km"))
    if small(places, broadcast_rows):
        return out(at.join(F.broadcast(own)).withColumn("_km", km).groupBy(*key).agg(best))
    done, size = None, start_degrees
    while True:
        if size < 90:
            met = at.withColumn("_c", globe_cell(F.col("_lat"), F.col("_lon"), size)).join(own.withColumn("_c", F.explode(globe_cells(F.col("_plat"), F.col("_plon"), size))), "_c")
        else:  # points this far from any place, of which an open sea has few
            met = at.withColumn("_c", F.lit(0)).join(own.withColumn("_c", F.lit(0)), "_c")
        found = met.withColumn("_km", km).groupBy(*key).agg(best)
        sure = out(found.filter(F.col("b._km") <= size * DEGREE_KM) if size < 90 else found).persist()
        done = sure if done is None else done.unionByName(sure)
        at = at.join(sure.select(*key), key, "left_anti").persist()
        if size >= 90 or at.isEmpty():
            return done
        size *= 4


def in_boxes(points: DataFrame, boxes: DataFrame, lat: str, lon: str, metres: float, size: float = 0.1) -> DataFrame:
    """Points joined with the boxes, widened by ``metres``, that hold them: an equi-join on grid cells.

    Boxes go to all cells that their widened extent meets, points to one.
    """
    by = metres / DEFAULT.metres_per_degree
    wide = F.lit(by) / F.cos(F.radians(F.least(F.greatest(F.abs("min_lat"), F.abs("max_lat")) + by, F.lit(89.9))))
    span = lambda a, b: F.sequence(F.floor(a / size).cast("int"), F.floor(b / size).cast("int"))
    ys, xs = span(F.col("min_lat") - by, F.col("max_lat") + by), span(F.col("min_lon") - wide, F.col("max_lon") + wide)
    laid = boxes.withColumn("_y", F.explode(ys)).withColumn("_x", F.explode(xs))
    here = points.withColumn("_y", cell(F.col(lat), size)).withColumn("_x", cell(F.col(lon), size))
    met = here.join(laid, ["_y", "_x"]).drop("_y", "_x")
    return met.filter(in_box(F.col(lat), F.col(lon), *[F.col(k) for k in ("min_lat", "min_lon", "max_lat", "max_lon")], metres))


def near_places(points: DataFrame, places: DataFrame, lat: str, lon: str, degrees: float = DEFAULT.place_box_degrees) -> DataFrame:
    """Points joined with the places within ``degrees`` of latitude and as far in longitude, where a degree shrinks with the point's latitude,
    with their distance ``metres``."""
    size = 1.5 * degrees  # a box's corner is farther than its sides
    own = places.withColumnsRenamed({"latitude": "_plat", "longitude": "_plon"}).withColumn("_c", F.explode(globe_cells(F.col("_plat"), F.col("_plon"), size)))
    here = points.withColumn("_c", globe_cell(F.col(lat), F.col(lon), size))
    met = here.join(own, "_c").filter((F.abs(F.col("_plat") - F.col(lat)) <= degrees) & (F.abs(F.col("_plon") - F.col(lon)) <= F.lit(degrees) / F.cos(F.radians(F.col(lat)))))
    return met.withColumn("metres", haversine(F.col(lat), F.col(lon), F.col("_plat"), F.col("_plon")) * 1000.0).drop("_c", "_plat", "_plon")


def alone(points: DataFrame, lat: str, lon: str, owner: str, km: float) -> DataFrame:
    """Points that have no point of another owner within ``km``; points of no owner or place are left out.

    First by cells so small that all their points are near each other: where two owners meet, none is alone, and a crowd is never
    compared.  The few that are left are compared with the distinct points around them.
    """
    size = km / DEGREE_KM
    own = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(owner).isNotNull()).withColumn("_pid", F.xxhash64(*points.columns))
    # A third of the reach in both directions; at this latitude's narrower edge a column is no wider than that.
    fine = size / 3.0
    y = cell(F.col(lat), fine)
    around = F.greatest(F.lit(1.0), F.ceil(360.0 * F.cos(F.radians(F.least(F.abs(y), F.abs(y + 1)) * F.lit(fine))) / fine))
    own = own.withColumn("_f", F.struct(y.alias("y"), F.floor((F.col(lon) + 180.0) / 360.0 * around).cast("long").alias("x")))
    owners = own.groupBy("_f").agg(F.min(owner).alias("_a"), F.max(owner).alias("_b"))
    left = own.join(owners.filter("_a = _b").select("_f"), "_f", "left_semi").withColumn("_c", globe_cell(F.col(lat), F.col(lon), size))
    others = own.select(F.col(owner).alias("_o"), F.col(lat).alias("_olat"), F.col(lon).alias("_olon")).distinct().withColumn("_c", F.explode(globe_cells(F.col("_olat"), F.col("_olon"), size)))
    met = left.join(others, "_c").filter((F.col("_o") != F.col(owner)) & (haversine(F.col(lat), F.col(lon), F.col("_olat"), F.col("_olon")) <= km))
    return left.join(met.select("_pid").distinct(), "_pid", "left_anti").select(*points.columns)


def within(spans: DataFrame, events: DataFrame, key: str, start: str, end: str, at: str, how: str = "inner") -> DataFrame:
    """Interval join: ``events`` of the same key at a time in [start, end].

    Both sides carry the days that they touch, so a key with many events is split by day.
    """
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))
    laid = spans.withColumn("_day", F.explode(days))
    own = events.withColumn("_day", F.col(at).cast("date"))
    met = laid.join(own, [key, "_day"]).filter(F.col(at).between(F.col(start), F.col(end))).drop("_day")
    if how == "inner":
        return met
    keys = [c for c in spans.columns if c == key or c in (start, end)]
    return spans.join(met.select(*keys, *[c for c in events.columns if c != key]), keys, "left")


