"""Spatial joins as equi-joins on grid cells, refined by the exact predicate.

A theta join on distances or containment would be a nested loop. Here each side
gets the number of its grid cell, the larger shapes one for every cell that
they touch, and the join is on the cell: a hash or sort-merge join that is
spread over the cluster, with a number of candidates that follows the local
density. Nothing is broadcast by hand; the engine does it by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.functions.points import box_distance, haversine_m, planar_distance

NEAREST_DEGREES = 0.05


def _cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size)).cast("long")


def _point_cells(points: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return points.withColumns({"_cx": _cell(F.col(x), size), "_cy": _cell(F.col(y), size)})


def _box_cells(boxes: DataFrame, size: float, margin: float, names: tuple[str, str, str, str]) -> DataFrame:
    """A row for each cell that a box, widened by the margin, touches."""
    west, south, east, north = (F.col(n) for n in names)
    across = F.explode(F.sequence(_cell(west - margin, size), _cell(east + margin, size)))
    along = F.explode(F.sequence(_cell(south - margin, size), _cell(north + margin, size)))
    return boxes.withColumn("_cx", across).withColumn("_cy", along)


def box_candidates(points: DataFrame, boxes: DataFrame, size: float, margin: float = 0.0, x: str = "lon", y: str = "lat", names: tuple[str, str, str, str] = ("west", "south", "east", "north")) -> DataFrame:
    """Each point with each box that it may be within ``margin`` of; a pair at most once."""
    return _point_cells(points, x, y, size).join(_box_cells(boxes, size, margin, names), ["_cx", "_cy"]).drop("_cx", "_cy")


def assign_boxes(points: DataFrame, boxes: DataFrame, key: str, code: str, nearest: float = NEAREST_DEGREES, size: float = 1.0) -> DataFrame:
    """Two-tier assignment: the smallest code of a box that holds the point, else the nearest within a radius, else none.

    Returns ``key``, ``code`` and ``method`` (within, nearest, none) for every
    point. One grouped minimum serves both tiers: inside a box the distance is
    0, so (distance, code) orders boxes that hold the point first. Boundaries
    count as inside.
    """
    far = box_distance(*(F.col(c) for c in ("lon", "lat", "west", "south", "east", "north")))
    near = box_candidates(points.select(key, "lon", "lat"), boxes, size, nearest).select(key, F.struct(far.alias("d"), F.col(code).alias("code")).alias("best")).where(F.col("best.d") <= nearest)
    best = near.groupBy(key).agg(F.min("best").alias("best"))
    method = F.when(F.col("best.d") == 0, "within").when(F.col("best").isNotNull(), "nearest").otherwise("none")
    return points.select(key).join(best, key, "left").select(key, F.col("best.code").alias(code), method.alias("method"))


def within_distance(left: DataFrame, right: DataFrame, degrees: float, left_xy: tuple[str, str], right_xy: tuple[str, str]) -> DataFrame:
    """All pairs of points at most ``degrees`` apart (planar), with ``distance``.

    The right side takes the 3 by 3 cells around its point, so each pair meets
    in exactly one cell.
    """
    near = F.explode(F.sequence(F.lit(-1).cast("long"), F.lit(1).cast("long")))
    spread = _point_cells(right, *right_xy, degrees).withColumn("_dx", near).withColumn("_dy", near)
    spread = spread.withColumns({"_cx": F.col("_cx") + F.col("_dx"), "_cy": F.col("_cy") + F.col("_dy")}).drop("_dx", "_dy")
    pairs = _point_cells(left, *left_xy, degrees).join(spread, ["_cx", "_cy"]).drop("_cx", "_cy")
    apart = planar_distance(F.col(left_xy[0]), F.col(left_xy[1]), F.col(right_xy[0]), F.col(right_xy[1]))
    return pairs.withColumn("distance", apart).where(F.col("distance") <= degrees)


def nearest_within(left: DataFrame, right: DataFrame, key: str, right_key: str, degrees: float, left_xy: tuple[str, str], right_xy: tuple[str, str]) -> DataFrame:
    """For each left point the nearest right one in metres, searched within ``degrees``; ties to the smaller key."""
    pairs = within_distance(left, right, degrees, left_xy, right_xy)
    metres = haversine_m(F.col(left_xy[0]), F.col(left_xy[1]), F.col(right_xy[0]), F.col(right_xy[1]))
    best = F.min(F.struct(metres.alias("distance_m"), F.col(right_key).alias("other")))
    return pairs.groupBy(key).agg(best.alias("best")).select(key, F.col("best.other").alias(right_key), F.col("best.distance_m").alias("distance_m"))


def nearest_of_few(left: DataFrame, few: DataFrame, key: str, few_key: str, left_xy: tuple[str, str], few_xy: tuple[str, str], most: int = 10_000) -> DataFrame:
    """For each left point the nearest of a small table at any distance.

    The small table is packed into one row, whose size is checked, and looked
    through point by point; ``most`` bounds it.
    """
    n = few.count()
    if n > most:
        raise ValueError(f"{n} rows: search within a distance instead")
    packed = few.agg(F.collect_list(F.struct(F.col(few_key).alias("k"), F.col(few_xy[0]).alias("x"), F.col(few_xy[1]).alias("y"))).alias("_few"))
    metres = lambda s: F.struct(haversine_m(F.col(left_xy[0]), F.col(left_xy[1]), s["x"], s["y"]).alias("distance_m"), s["k"].alias("k"))
    best = F.array_min(F.transform("_few", metres))
    return left.join(F.broadcast(packed)).select(key, best.alias("best")).select(key, F.col("best.k").alias(few_key), F.col("best.distance_m").alias("distance_m"))
