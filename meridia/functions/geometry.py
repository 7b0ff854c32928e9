"""Geometries as little-endian WKB in binary columns: codec, measures and predicates.

Python functions work on whole Arrow batches with numpy; the column functions
wrap them as Arrow UDFs. A geometry is parsed to its parts: a kind and a list
of parts, each a list of rings (arrays of longitude and latitude).
"""

from __future__ import annotations

import json
import math
import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

#: WKB's type codes.
CODES = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 4, "MULTILINESTRING": 5, "MULTIPOLYGON": 6}
NAMES = {code: name for name, code in CODES.items()}
#: The WGS 84 ellipsoid.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
_E2 = WGS84_F * (2 - WGS84_F)


class Geometry:
    """A kind and its parts; a part is a list of rings, of which points and lines have one."""

    def __init__(self, kind: str, parts: list[list[np.ndarray]]) -> None:
        self.kind, self.parts = kind, parts

    @property
    def dimension(self) -> int:
        return {"POINT": 0, "LINESTRING": 1, "POLYGON": 2}[self.kind.removeprefix("MULTI")]

    @property
    def is_empty(self) -> bool:
        return not any(len(r) for p in self.parts for r in p)

    def coordinates(self) -> np.ndarray:
        rings = [r for p in self.parts for r in p if len(r)]
        return np.concatenate(rings) if rings else np.empty((0, 2))

    def envelope(self) -> tuple[float, float, float, float] | None:
        c = self.coordinates()
        return (*c.min(axis=0).tolist(), *c.max(axis=0).tolist()) if len(c) else None

    def multi(self) -> Geometry:
        return self if self.kind.startswith("MULTI") else Geometry(f"MULTI{self.kind}", self.parts)

    def flipped(self) -> Geometry:
        return Geometry(self.kind, [[r[:, ::-1] for r in p] for p in self.parts])


def read_wkb(data: bytes) -> Geometry:
    at = 0

    def take(code: str, n: int = 1):
        nonlocal at
        out = np.frombuffer(data, dtype=order + code, count=n, offset=at)
        at += out.nbytes
        return out

    def ring() -> np.ndarray:
        return take("f8", 2 * int(take("u4")[0])).reshape(-1, 2).astype(float)

    def one() -> tuple[str, list[list[np.ndarray]]]:
        nonlocal at, order
        order = "<" if data[at] else ">"
        at += 1
        kind = NAMES[int(take("u4")[0]) & 0xFF]
        if kind == "POINT":
            p = take("f8", 2).reshape(1, 2).astype(float)
            return kind, [[p if np.isfinite(p).all() else p[:0]]]
        if kind == "LINESTRING":
            return kind, [[ring()]]
        if kind == "POLYGON":
            return kind, [[ring() for _ in range(int(take("u4")[0]))]]
        return kind, [p for _ in range(int(take("u4")[0])) for p in one()[1]]

    order = "<"
    return Geometry(*one())


def write_wkb(g: Geometry) -> bytes:
    def ring(r: np.ndarray) -> bytes:
        return struct.pack("<I", len(r)) + np.asarray(r, dtype="<f8").tobytes()

    def one(kind: str, part: list[np.ndarray]) -> bytes:
        head = struct.pack("<BI", 1, CODES[kind])
        if kind == "POINT":
            return head + (np.asarray(part[0], dtype="<f8").tobytes() if len(part[0]) else struct.pack("<dd", math.nan, math.nan))
        if kind == "LINESTRING":
            return head + ring(part[0])
        return head + struct.pack("<I", len(part)) + b"".join(map(ring, part))

    if not g.kind.startswith("MULTI"):
        return one(g.kind, g.parts[0] if g.parts else [] if g.kind == "POLYGON" else [np.empty((0, 2))])
    return struct.pack("<BII", 1, CODES[g.kind], len(g.parts)) + b"".join(one(g.kind[5:], p) for p in g.parts)


def read_wkt(text: str) -> Geometry:
    kind, body = re.fullmatch(r"\s*([A-Za-z]+)\s*(.*?)\s*", text, re.DOTALL).groups()
    kind = kind.upper()
    if kind not in CODES:
        raise ValueError(f"unknown geometry {text[:40]!r}")
    if body.upper() == "EMPTY":
        return Geometry(kind, [])
    nested = json.loads(re.sub(r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)\s+(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)", r"[\1, \2]", body).replace("(", "[").replace(")", "]"))
    return from_coordinates(kind, nested[0] if kind == "POINT" else nested)


def write_wkt(g: Geometry) -> str:
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in r.tolist()) + ")"
    if g.is_empty:
        return f"{g.kind} EMPTY"
    single = g.kind.removeprefix("MULTI")
    parts = [ring(p[0]) if single != "POLYGON" else "(" + ", ".join(map(ring, p)) + ")" for p in g.parts]
    return f"{g.kind} " + (parts[0] if g.kind == single else "(" + ", ".join(parts) + ")")


def from_coordinates(kind: str, nested: list) -> Geometry:
    """A geometry from GeoJSON's nesting of coordinates."""
    array = lambda x: np.asarray(x, dtype=float).reshape(-1, 2)
    single = kind.removeprefix("MULTI")
    items = nested if kind.startswith("MULTI") else [nested]
    if single == "POLYGON":
        return Geometry(kind, [[array([p[:2] for p in r]) for r in item] for item in items])
    if single == "POINT":
        return Geometry(kind, [[array(item[0] if kind.startswith("MULTI") and isinstance(item[0], list) else item[:2])] for item in items])
    return Geometry(kind, [[array([p[:2] for p in item])] for item in items])


def read_geojson(text: str) -> Geometry:
    told = json.loads(text)
    return from_coordinates(told["type"].upper(), told["coordinates"])


def write_geojson(g: Geometry) -> str:
    names = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon"}
    single = g.kind.removeprefix("MULTI")
    items = [[r.tolist() for r in p] if single == "POLYGON" else p[0].tolist() if single == "LINESTRING" else p[0][0].tolist() for p in g.parts]
    return json.dumps({"type": ("Multi" if g.kind != single else "") + names[single], "coordinates": items if g.kind != single else items[0]})


# measures and predicates ------------------------------------------------------------------


def in_rings(part: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ray casting over a shell and its holes; points on a boundary count as outside or inside by side."""
    inside = np.zeros(len(x), dtype=bool)
    for ring in part:
        a, b = ring[:-1], ring[1:]
        for (x1, y1), (x2, y2) in zip(a, b, strict=True):
            if y1 != y2:
                inside ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return inside


def on_boundary(part: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=bool)
    for ring in part:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            out |= (cross == 0) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
    return out


def points_within(g: Geometry, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether points lie inside; the boundary is outside."""
    out, edge = np.zeros(len(x), dtype=bool), np.zeros(len(x), dtype=bool)
    if g.dimension == 2:
        for part in g.parts:
            out |= in_rings(part, x, y)
            edge |= on_boundary(part, x, y)
    return out & ~edge


def points_distance(g: Geometry, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Planar distance of points to a geometry, 0 inside polygons and on their boundary."""
    best = np.full(len(x), np.inf)
    for part in g.parts:
        for ring in part:
            if len(ring) == 1:
                best = np.minimum(best, np.hypot(x - ring[0, 0], y - ring[0, 1]))
            for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
                dx, dy = x2 - x1, y2 - y1
                size = dx * dx + dy * dy
                t = np.clip(((x - x1) * dx + (y - y1) * dy) / size, 0, 1) if size else 0.0
                best = np.minimum(best, np.hypot(x - x1 - t * dx, y - y1 - t * dy))
        if g.dimension == 2:
            best = np.where(in_rings(part, x, y) | on_boundary(part, x, y), 0.0, best)
    return best


def intersects(a: Geometry, b: Geometry) -> bool:
    """Whether two geometries share a point: a vertex of one inside the other, or crossing segments."""
    ea, eb = a.envelope(), b.envelope()
    if not ea or not eb or ea[0] > eb[2] or eb[0] > ea[2] or ea[1] > eb[3] or eb[1] > ea[3]:
        return False
    for g, h in ((a, b), (b, a)):
        c = h.coordinates()
        if (points_distance(g, c[:, 0], c[:, 1]) == 0).any():
            return True
    segments = lambda g: np.concatenate([np.hstack((r[:-1], r[1:])) for p in g.parts for r in p] or [np.empty((0, 4))])
    s, t = segments(a), segments(b)
    if not len(s) or not len(t):
        return False
    side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    p, q, u, v = s[:, None, :2], s[:, None, 2:], t[None, :, :2], t[None, :, 2:]
    return bool(((side(p, q, u) * side(p, q, v) < 0) & (side(u, v, p) * side(u, v, q) < 0)).any())


def is_valid(g: Geometry) -> bool:
    """Whether coordinates are finite, rings are closed, long enough and do not cross themselves or each other."""
    for part in g.parts:
        if not all(np.isfinite(r).all() for r in part):
            return False
        if g.dimension == 1 and any(len(r) < 2 for r in part):
            return False
        if g.dimension == 2:
            if any(len(r) < 4 or (r[0] != r[-1]).any() for r in part):
                return False
            s = np.concatenate([np.hstack((r[:-1], r[1:])) for r in part])
            side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
            for i in range(0, len(s), 256):  # in blocks, so that long rings take bounded memory
                p, q, u, v = s[i : i + 256, None, :2], s[i : i + 256, None, 2:], s[None, :, :2], s[None, :, 2:]
                if ((side(p, q, u) * side(p, q, v) < 0) & (side(u, v, p) * side(u, v, q) < 0)).any():
                    return False
    return True


def geodesic_m(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Length of geodesics on WGS 84 by Vincenty's inverse formula, in metres."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, dtype=float)) for v in (lon1, lat1, lon2, lat2))
    u1, u2 = np.arctan((1 - WGS84_F) * np.tan(lat1)), np.arctan((1 - WGS84_F) * np.tan(lat2))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    gap = lon2 - lon1
    turn = gap.copy() if gap.ndim else gap
    for _ in range(50):
        s, c = np.sin(turn), np.cos(turn)
        sin_sigma = np.hypot(cu2 * s, cu1 * su2 - su1 * cu2 * c)
        cos_sigma = su1 * su2 + cu1 * cu2 * c
        sigma = np.arctan2(sin_sigma, cos_sigma)
        with np.errstate(divide="ignore", invalid="ignore"):
            sin_alpha = np.where(sin_sigma == 0, 0.0, cu1 * cu2 * s / sin_sigma)
            cos2_alpha = 1 - sin_alpha**2
            middle = np.where(cos2_alpha == 0, 0.0, cos_sigma - 2 * su1 * su2 / cos2_alpha)
        k = WGS84_F / 16 * cos2_alpha * (4 + WGS84_F * (4 - 3 * cos2_alpha))
        turned = gap + (1 - k) * WGS84_F * sin_alpha * (sigma + k * sin_sigma * (middle + k * cos_sigma * (2 * middle**2 - 1)))
        done = np.all(np.abs(turned - turn) < 1e-13)
        turn = turned
        if done:
            break
    square = cos2_alpha * (WGS84_A**2 - WGS84_B**2) / WGS84_B**2
    big = 1 + square / 16384 * (4096 + square * (-768 + square * (320 - 175 * square)))
    small = square / 1024 * (256 + square * (-128 + square * (74 - 47 * square)))
    delta = small * sin_sigma * (middle + small / 4 * (cos_sigma * (2 * middle**2 - 1) - small / 6 * middle * (4 * sin_sigma**2 - 3) * (4 * middle**2 - 3)))
    return WGS84_B * big * (sigma - delta)


def length_m(g: Geometry) -> float:
    """Geodesic length of a geometry's lines."""
    return float(sum(geodesic_m(r[:-1, 0], r[:-1, 1], r[1:, 0], r[1:, 1]).sum() for p in g.parts for r in p if len(r) > 1))


def _authalic_sine(lat: np.ndarray) -> np.ndarray:
    e = math.sqrt(_E2)
    q = lambda s: (1 - _E2) * (s / (1 - _E2 * s * s) + np.arctanh(e * s) / e)
    return q(np.sin(np.radians(lat))) / q(1.0)


def area_m2(g: Geometry) -> float:
    """Area on WGS 84 by way of the sphere of equal area; sides are straight in longitude and the authalic sine."""
    e = math.sqrt(_E2)
    radius2 = WGS84_A**2 / 2 * (1 + (1 - _E2) / e * math.atanh(e))

    def ring(r: np.ndarray) -> float:
        s = _authalic_sine(r[:, 1])
        return abs(float((np.radians(np.diff(r[:, 0])) * (s[1:] + s[:-1]) / 2).sum())) * radius2

    return sum(ring(p[0]) - sum(map(ring, p[1:])) for p in g.parts if p) if g.dimension == 2 else 0.0


def convex_hull(points: np.ndarray) -> Geometry:
    """Hull of points by monotone chain: a polygon, or a line or point if they are in line."""
    p = sorted(set(map(tuple, np.asarray(points, dtype=float).tolist())))
    if len(p) == 1:
        return Geometry("POINT", [[np.array(p)]])

    def half(order: list) -> list:
        out: list = []
        for q in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    shell = half(p) + half(p[::-1])
    return Geometry("POLYGON", [[np.array([*shell, shell[0]])]]) if len(shell) > 2 else Geometry("LINESTRING", [[np.array(shell)]])


def collection_extract(parts: list[Geometry], dimension: int) -> list[Geometry]:
    return [g for g in parts if g.dimension == dimension]


# columns ----------------------------------------------------------------------------------


def arrow_rows(kind: str, f: Callable) -> Callable:
    """A column function of ``f`` on rows, over Arrow arrays; null arguments give null."""
    arrow_type = to_arrow_type(_parse_datatype_string(kind))

    def run(*columns):
        values = [None if any(v is None for v in row) else f(*row) for row in zip(*(c.to_pylist() for c in columns), strict=True)]
        return pa.array(values, arrow_type)

    def one(a: pa.Array) -> pa.Array:
        return run(a)

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return run(a, b)

    def three(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        return run(a, b, c)

    return lambda *columns: F.arrow_udf((one, two, three)[len(columns) - 1], kind)(*columns)


def contains_point(shape: str, x: str, y: str) -> Column:
    """ST_Within of points in polygons; equal shapes of a batch are parsed once and tested together."""

    def run(shapes: pa.Array, xs: pa.Array, ys: pa.Array) -> pa.Array:
        coded = shapes.dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False)
        px, py = (a.cast(pa.float64()).to_numpy(zero_copy_only=False) for a in (xs, ys))
        out = np.zeros(len(shapes), dtype=bool)
        for i, data in enumerate(coded.dictionary.to_pylist()):
            at = np.flatnonzero(places == i)
            out[at] = points_within(read_wkb(data), px[at], py[at])
        return pa.array(out)

    return F.arrow_udf(run, "boolean")(shape, x, y)


def distance_to(shape: str, x: str, y: str) -> Column:
    return arrow_rows("double", lambda s, a, b: float(points_distance(read_wkb(s), np.array([a]), np.array([b]))[0]))(shape, x, y)


def length_spheroid(shape: str) -> Column:
    return arrow_rows("double", lambda s: length_m(read_wkb(s)))(shape)


def area_km2(shape: str) -> Column:
    return arrow_rows("double", lambda s: area_m2(read_wkb(s)) / 1e6)(shape)


def shapes_intersect(a: str, b: str) -> Column:
    return arrow_rows("boolean", lambda s, t: intersects(read_wkb(s), read_wkb(t)))(a, b)


def envelope(shape: str) -> Column:
    return arrow_rows("struct<west:double,south:double,east:double,north:double>", lambda s: dict(zip(("west", "south", "east", "north"), read_wkb(s).envelope() or (None,) * 4, strict=True)))(shape)


def wkb_from_text(text: str) -> Column:
    return arrow_rows("binary", lambda t: write_wkb(read_wkt(t)))(text)


def text_from_wkb(shape: str) -> Column:
    return arrow_rows("string", lambda s: write_wkt(read_wkb(s)))(shape)


def wkb_from_geojson(text: str) -> Column:
    return arrow_rows("binary", lambda t: write_wkb(read_geojson(t)))(text)


def geojson_from_wkb(shape: str) -> Column:
    return arrow_rows("string", lambda s: write_geojson(read_wkb(s)))(shape)


def _coordinates(points: list) -> np.ndarray:
    return np.array([(p["lon"], p["lat"]) for p in points], dtype=float).reshape(-1, 2)


def line_wkb(points: Column) -> Column:
    """A line from an array of (lon, lat)."""
    return arrow_rows("binary", lambda p: write_wkb(Geometry("LINESTRING", [[_coordinates(p)]])))(points)


def polygon_wkb(points: Column) -> Column:
    """A polygon from a closed array of (lon, lat)."""
    return arrow_rows("binary", lambda p: write_wkb(Geometry("POLYGON", [[_coordinates(p)]])))(points)


def hull_wkb(points: Column) -> Column:
    """The convex hull of an array of (lon, lat)."""
    return arrow_rows("binary", lambda p: write_wkb(convex_hull(_coordinates(p))))(points)


def is_empty(shape: str) -> Column:
    return arrow_rows("boolean", lambda s: read_wkb(s).is_empty)(shape)


def valid(shape: str) -> Column:
    return arrow_rows("boolean", lambda s: is_valid(read_wkb(s)))(shape)
