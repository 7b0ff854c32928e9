"""Points as two double columns: planar and spherical distance, boxes, WKB and WKT of simple shapes.

All of these are column expressions that stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
METRES_PER_DEGREE = 111_000.0
CRS = "OGC:CRS84"


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance in the units of the coordinates."""
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def box_distance(x: Column, y: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Distance of a point to a box, 0 inside."""
    dx = F.greatest(west - x, F.lit(0.0), x - east)
    dy = F.greatest(south - y, F.lit(0.0), y - north)
    return F.sqrt(dx * dx + dy * dy)


def outside_box(x_min: Column, y_min: Column, x_max: Column, y_max: Column, south: float, west: float, north: float, east: float) -> Column:
    """Whether an envelope reaches beyond an extent."""
    return (x_min < west) | (x_max > east) | (y_min < south) | (y_max > north)


def _little_endian_double(value: Column) -> Column:
    """The eight bytes of a double, hexadecimal, least significant first."""
    raw = F.lpad(F.hex(F.expr("0L") + _double_bits(value)), 16, "0")
    return F.concat(*(F.substring(raw, 15 - 2 * i, 2) for i in range(8)))


def _double_bits(value: Column) -> Column:
    """IEEE 754 bits of a finite double, by arithmetic: sign, exponent and fraction."""
    size = F.abs(value)
    # the exponent is estimated by logarithm and corrected where rounding put it one off
    guess = F.floor(F.log2(size)).cast("int")
    low = F.pow(F.lit(2.0), guess.cast("double"))
    exponent = F.when(low > size, guess - 1).when(low * 2 <= size, guess + 1).otherwise(guess)
    fraction = (size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * F.lit(float(1 << 52))
    bits = F.shiftleft((exponent + 1023).cast("long"), 52) + fraction.cast("long")
    signed = F.when(value < 0, bits.bitwiseOR(F.lit(-(1 << 63)))).otherwise(bits)
    return F.when(value == 0, F.lit(0).cast("long")).otherwise(signed)


def point_wkb(lon: Column, lat: Column) -> Column:
    """WKB of a point (for coordinates of normal size, as degrees are)."""
    return F.unhex(F.concat(F.lit("0101000000"), _little_endian_double(lon), _little_endian_double(lat)))


def geometry_type(wkb: Column) -> Column:
    """Name of a little-endian WKB geometry's type."""
    code = F.conv(F.hex(F.substring(wkb, 2, 1)), 16, 10).cast("int")
    names = ("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION")
    return F.element_at(F.array(*map(F.lit, names)), code)


def point_from_wkt(text: Column) -> Column:
    """struct(lon, lat) of a text like ``Point(lon lat)``; null if it is none."""
    number = r"(-?[0-9]+(?:\.[0-9]+)?)"
    pattern = rf"(?i)^\s*point\s*\(\s*{number}\s+{number}\s*\)\s*$"
    lon, lat = (F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast("double") for i in (1, 2))
    return F.when(lon.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def box_wkt(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A box as a polygon in WKT."""
    corner = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    ring = F.concat_ws(", ", corner(west, south), corner(east, south), corner(east, north), corner(west, north), corner(west, south))
    return F.concat(F.lit("POLYGON (("), ring, F.lit("))"))


def is_closed(points: Column) -> Column:
    """Whether an array of (lon, lat) ends where it begins."""
    return (F.size(points) > 0) & (F.element_at(points, 1) == F.element_at(points, -1))


def ring_area(points: Column) -> Column:
    """Planar area of a closed array of (lon, lat), by the shoelace formula."""
    steps = F.sequence(F.lit(1), F.size(points) - 1)
    cross = lambda i: F.element_at(points, i)["lon"] * F.element_at(points, i + 1)["lat"] - F.element_at(points, i + 1)["lon"] * F.element_at(points, i)["lat"]
    return F.when(F.size(points) > 2, F.abs(F.aggregate(F.transform(steps, cross), F.lit(0.0), lambda a, b: a + b)) / 2).otherwise(0.0)
