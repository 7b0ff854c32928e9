"""Rasters: relief shading, lines of sight, masks, mosaics, and their outlines.

``hillshade_pixels`` shades a table of pixels with window functions only; the
numpy functions work on one tile at a time and are used through ``mapInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridia.functions.geometry import Geometry, points_within

#: Metres in a degree, and the shading's light.
METRES_PER_DEGREE = 111_320.0
AZIMUTH, ALTITUDE = 315.0, 45.0
#: Fixed value: share of the curvature drop that refraction leaves.
CURVATURE = 0.85714
EARTH_DIAMETER_M = 12_741_994.0


def _light(azimuth: float, altitude: float) -> tuple[float, float]:
    return math.radians(90 - altitude), math.radians((450 - azimuth) % 360)


def hillshade(dem: np.ndarray, dx: float, dy: float, lats: np.ndarray, nodata: float | None = None, azimuth: float = AZIMUTH, altitude: float = ALTITUDE) -> np.ndarray:
    """Horn's shading of a grid in degrees: 1 to 255, and 0 where a pixel or a neighbour has no value."""
    z = np.where(np.isfinite(dem) & (dem != nodata if nodata is not None else True), dem, np.nan).astype(float)
    p = np.pad(z, 1, mode="edge")
    at = lambda r, c: p[1 + r : p.shape[0] - 1 + r, 1 + c : p.shape[1] - 1 + c]
    across = at(-1, 1) + 2 * at(0, 1) + at(1, 1) - at(-1, -1) - 2 * at(0, -1) - at(1, -1)
    down = at(1, -1) + 2 * at(1, 0) + at(1, 1) - at(-1, -1) - 2 * at(-1, 0) - at(-1, 1)
    gx = across / (8 * dx * METRES_PER_DEGREE * np.cos(np.radians(lats)))[:, None]
    gy = down / (8 * dy * METRES_PER_DEGREE)
    zenith, light = _light(azimuth, altitude)
    slope, aspect = np.arctan(np.hypot(gx, gy)), np.arctan2(gy, -gx)
    shade = np.cos(slope) * math.cos(zenith) + np.sin(slope) * math.sin(zenith) * np.cos(light - aspect)
    return np.where(np.isnan(shade) | np.isnan(z), 0, np.clip(np.rint(1 + 254 * np.clip(shade, 0, 1)), 1, 255)).astype(np.uint8)


def hillshade_pixels(pixels: DataFrame, dx: float, dy: float, azimuth: float = AZIMUTH, altitude: float = ALTITUDE) -> DataFrame:
    """Shade a table (row, col, lat, value): one window along rows for the sides, one along columns.

    A pixel without a neighbour takes its own row or column in its place. Each
    window is partitioned by row or column, so a large raster spreads over tasks.
    """
    along = Window.partitionBy("row").orderBy("col")
    side = lambda k: F.coalesce(F.lag("value", 1).over(along) if k < 0 else F.lead("value", 1).over(along), F.col("value"))
    rows = pixels.select("*", side(-1).alias("_w"), side(1).alias("_e"))
    rows = rows.withColumns({"_across": F.col("_e") - F.col("_w"), "_sum": F.col("_w") + 2 * F.col("value") + F.col("_e")})
    up = Window.partitionBy("col").orderBy("row")
    n = lambda c: F.coalesce(F.lag(c, 1).over(up), F.col(c))
    s = lambda c: F.coalesce(F.lead(c, 1).over(up), F.col(c))
    both = rows.select(*pixels.columns, (n("_across") + 2 * F.col("_across") + s("_across")).alias("_gx"), (s("_sum") - n("_sum")).alias("_gy"))
    gx = F.col("_gx") / (F.lit(8 * dx * METRES_PER_DEGREE) * F.cos(F.radians("lat")))
    gy = F.col("_gy") / F.lit(8 * dy * METRES_PER_DEGREE)
    zenith, light = _light(azimuth, altitude)
    slope, aspect = F.atan(F.sqrt(gx * gx + gy * gy)), F.atan2(gy, -gx)
    shade = F.cos(slope) * math.cos(zenith) + F.sin(slope) * math.sin(zenith) * F.cos(F.lit(light) - aspect)
    value = F.greatest(F.lit(1.0), F.least(F.lit(255.0), F.rint(1 + 254 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), shade)))))
    return both.select(*pixels.columns, F.coalesce(value, F.lit(0.0)).cast("int").alias("shade"))


def viewshed(dem: np.ndarray, row: int, col: int, pixel_m: float, observer_m: float = 1.7, target_m: float = 1.7, farthest_m: float = math.inf) -> np.ndarray:
    """Where a target can be seen from one pixel: lines of sight to every pixel, sampled at each
    pixel's step with the ground in between interpolated.

    A pixel is seen if no nearer sample of its line rises above it; curvature and
    refraction lower far ground. 255 seen, 0 not.
    """
    h, w = dem.shape
    rows, cols = np.mgrid[0:h, 0:w]
    dr, dc = rows - row, cols - col
    steps = np.maximum(np.abs(dr), np.abs(dc))
    away = np.hypot(dr, dc) * pixel_m
    drop = lambda d: CURVATURE * d * d / EARTH_DIAMETER_M
    eye = dem[row, col] + observer_m
    with np.errstate(divide="ignore", invalid="ignore"):
        wanted = (dem + target_m - drop(away) - eye) / away
        highest = np.full(dem.shape, -np.inf)
        for k in range(1, int(steps.max())):
            live = steps > k
            t = np.where(live, k / np.maximum(steps, 1), 0)
            r, c = row + dr * t, col + dc * t
            # a step meets pixels' centres along one axis and lies between two along the other
            r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
            r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
            fr, fc = r - r0, c - c0
            ground = (dem[r0, c0] * (1 - fr) + dem[r1, c0] * fr) * (1 - fc) + (dem[r0, c1] * (1 - fr) + dem[r1, c1] * fr) * fc
            d = away * t
            angle = (ground - drop(d) - eye) / d
            highest = np.where(live & np.isfinite(angle), np.maximum(highest, angle), highest)
    seen = (wanted >= highest) | (steps == 0)
    return np.where(seen & np.isfinite(dem) & (away <= farthest_m), 255, 0).astype(np.uint8)


def ring_observers(row: int, col: int, radius_m: float, n: int, pixel_m: float, shape: tuple[int, int]) -> list[tuple[int, int]]:
    """The centre and n points around it, those inside the grid."""
    out = [(row, col)]
    for i in range(n):
        a = 2 * math.pi * i / n
        r, c = round(row - radius_m * math.sin(a) / pixel_m), round(col + radius_m * math.cos(a) / pixel_m)
        if 0 <= r < shape[0] and 0 <= c < shape[1]:
            out.append((r, c))
    return out


def union_viewshed(dem: np.ndarray, observers: list[tuple[int, int]], pixel_m: float, **options) -> np.ndarray:
    return np.maximum.reduce([viewshed(dem, r, c, pixel_m, **options) for r, c in observers])


def highest_point(dem: np.ndarray, xs: np.ndarray, ys: np.ndarray, x: float, y: float, radius: float) -> tuple[float, float, float]:
    """x, y and height of the highest pixel within a radius."""
    near = (xs[None, :] - x) ** 2 + (ys[:, None] - y) ** 2 <= radius**2
    r, c = np.unravel_index(np.where(near, dem, -np.inf).argmax(), dem.shape)
    return float(xs[c]), float(ys[r]), float(dem[r, c])


def highest_pixel(pixels: DataFrame, x: float, y: float, radius: float) -> DataFrame:
    """The same on a table of pixels (lon, lat, value)."""
    near = (F.col("lon") - x) * (F.col("lon") - x) + (F.col("lat") - y) * (F.col("lat") - y) <= radius * radius
    return pixels.where(near).agg(F.max_by(F.struct("lon", "lat", "value"), "value").alias("p")).select("p.*")


def visible_share(pixels: DataFrame, column: str = "value", seen: int = 255) -> DataFrame:
    return pixels.agg(F.avg((F.col(column) == seen).cast("double")).alias("visible_share"))


def masked(value: Column, nodata: float, flag: Column, fill: int = 255) -> Column:
    """The value, null where it or its quality flag is empty."""
    return F.when((value != nodata) & (flag != fill) & ~F.isnan(value), value)


def paste(target: np.ndarray, piece: np.ndarray, row: int, col: int) -> None:
    """Copy a piece into a mosaic at a place, cutting what reaches beyond it."""
    top, left = max(0, row), max(0, col)
    bottom, right = min(target.shape[0], row + piece.shape[0]), min(target.shape[1], col + piece.shape[1])
    if top < bottom and left < right:
        target[top:bottom, left:right] = piece[top - row : bottom - row, left - col : right - col]


def rasterize(shapes: list[Geometry], west: float, north: float, dx: float, dy: float, shape: tuple[int, int]) -> np.ndarray:
    """1 where a pixel's centre lies in a polygon."""
    xs, ys = west + (np.arange(shape[1]) + 0.5) * dx, north - (np.arange(shape[0]) + 0.5) * dy
    x, y = np.meshgrid(xs, ys)
    out = np.zeros(x.size, dtype=bool)
    for g in shapes:
        out |= points_within(g, x.ravel(), y.ravel())
    return out.reshape(shape).astype(np.uint8)


def outlines(mask: np.ndarray, west: float, north: float, dx: float, dy: float) -> list[Geometry]:
    """Squares of each run of set pixels in a row; their union is the vector form of the mask."""
    out = []
    for i, line in enumerate(mask.astype(bool)):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], line.astype(int), [0]))))
        for a, b in edges.reshape(-1, 2):
            x1, x2, y1, y2 = west + a * dx, west + b * dx, north - i * dy, north - (i + 1) * dy
            out.append(Geometry("POLYGON", [[np.array([(x1, y2), (x2, y2), (x2, y1), (x1, y1), (x1, y2)])]]))
    return out


def utm(lon: np.ndarray, lat: np.ndarray, zone: int) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing on WGS 84 by the series for the transverse Mercator projection."""
    from meridia.functions.geometry import WGS84_A, WGS84_F

    e2 = WGS84_F * (2 - WGS84_F)
    second = e2 / (1 - e2)
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (6 * zone - 183))
    n = WGS84_A / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    t, c, a = np.tan(phi) ** 2, second * np.cos(phi) ** 2, np.cos(phi) * lam
    m = WGS84_A * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * np.sin(2 * phi) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * np.sin(4 * phi) - 35 * e2**3 / 3072 * np.sin(6 * phi))
    x = 0.9996 * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * second) * a**5 / 120) + 500_000
    y = 0.9996 * (m + n * np.tan(phi) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * second) * a**6 / 720))
    return x, y


def bilinear(values: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Values at fractional places between pixel centres; NaN outside."""
    h, w = values.shape
    inside = (rows >= 0) & (rows <= h - 1) & (cols >= 0) & (cols <= w - 1)
    r, c = np.clip(rows, 0, h - 1), np.clip(cols, 0, w - 1)
    r0, c0 = np.minimum(r.astype(int), h - 2), np.minimum(c.astype(int), w - 2)
    fr, fc = r - r0, c - c0
    v = values[r0, c0] * (1 - fr) * (1 - fc) + values[r0, c0 + 1] * (1 - fr) * fc + values[r0 + 1, c0] * fr * (1 - fc) + values[r0 + 1, c0 + 1] * fr * fc
    return np.where(inside, v, np.nan)
