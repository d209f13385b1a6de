"""Distances, boxes and grid cells as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewake.config import DEFAULT


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = DEFAULT.earth_km) -> Column:
    """Great-circle distance in the radius' unit; arguments are degrees as doubles."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), 2.0)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


HAVERSINE_SQL = "(2.0 * {radius}) * asin(sqrt(least(pow(sin(radians({lat2} - {lat1}) / 2.0), 2.0) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2.0), 2.0), 1.0)))"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = DEFAULT.earth_km) -> str:
    return HAVERSINE_SQL.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2, radius=radius)


def in_box(lat: Column, lon: Column, min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column, metres: float) -> Column:
    """Inside the box widened by ``metres`` on each side; a degree of longitude shrinks with the latitude."""
    by = metres / DEFAULT.metres_per_degree
    wide = F.lit(by) / F.cos(F.radians(lat))
    return lat.between(min_lat - by, max_lat + by) & (lon >= min_lon - wide) & (lon <= max_lon + wide)


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("int")


def columns_of(row: Column, size: float) -> Column:
    """Cells of a row of a grid over the globe: as many as leave each at least as wide as ``size`` degrees of arc reach from any place of it.

    Rows whose surroundings hold a pole are one cell.
    """
    edge = (F.greatest(F.abs(row), F.abs(row + 1)) + 1) * F.lit(float(size))
    wide = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(float(size)))) / F.cos(F.radians(F.least(edge, F.lit(89.9)))))))
    return F.when(edge + size >= 90.0, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0) / wide).cast("int")))


def column_of(lon: Column, columns: Column) -> Column:
    return F.pmod(F.floor((lon + 180.0) / 360.0 * columns).cast("int"), columns)


def globe_cell(lat: Column, lon: Column, size: float) -> Column:
    """The cell (y, x) of a point."""
    y = cell(lat, size)
    return F.struct(y.alias("y"), column_of(lon, columns_of(y, size)).alias("x"))


def globe_cells(lat: Column, lon: Column, size: float) -> Column:
    """All cells in which a point within ``size`` degrees of arc may lie, across the date line and the poles too; to be exploded."""
    y = cell(lat, size)

    def of(row: Column) -> Column:
        n = columns_of(row, size)
        x = column_of(lon, n)
        return F.array_distinct(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.struct(row.alias("y"), F.pmod(x + d, n).alias("x"))))

    return F.flatten(F.transform(F.sequence(y - 1, y + 1), of))


def locode_coordinate(text: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of 'DDMMH DDDMMH', whole arc minutes as degrees."""
    part = lambda a, n: F.substring(text, a, n).cast("double")
    sign = lambda at, minus: F.when(F.substring(text, at, 1) == minus, F.lit(-1.0)).otherwise(F.lit(1.0))
    lat = (part(1, 2) + part(3, 2) / F.lit(60.0)) * sign(5, "S")
    lon = (part(7, 3) + part(10, 2) / F.lit(60.0)) * sign(12, "W")
    return lat, lon
