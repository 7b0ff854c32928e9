import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meridia.functions import geometry as g
from meridia.functions import hexgrid, points, text
from meridia.functions.topology import Topology, union_by
from meridia.raster import relief

SQUARE = "POLYGON ((139 35, 140 35, 140 36, 139 36, 139 35))"


@pytest.mark.parametrize("wkt", ["POINT (1.5 -2.0)", "LINESTRING (0.0 0.0, 1.0 2.0)", "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 0.5, 2.0 0.5, 2.0 1.0, 1.0 0.5))", "MULTILINESTRING ((0.0 0.0, 1.0 1.0), (2.0 2.0, 3.0 3.0))", "MULTIPOLYGON (((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0)))", "LINESTRING EMPTY"])
def test_codecs(wkt):
    shape = g.read_wkt(wkt)
    assert g.write_wkt(g.read_wkb(g.write_wkb(shape))) == wkt
    if not shape.is_empty:
        assert g.write_wkt(g.read_geojson(g.write_geojson(shape))) == wkt


def test_measures():
    square = g.read_wkt(SQUARE)
    assert 9_500 < g.area_m2(square) / 1e6 < 10_500
    assert 9_000 < g.length_m(g.read_wkt("LINESTRING (139 35, 139.1 35)")) < 9_300
    assert float(g.geodesic_m(0.0, 0.0, 0.0, 1.0)) == pytest.approx(110_574.389, abs=0.01)
    holed = g.read_wkt("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))")
    x, y = np.array([0.5, 2.0, 5.0, 0.0]), np.array([0.5, 2.0, 2.0, 2.0])
    assert g.points_within(holed, x, y).tolist() == [True, False, False, False]
    assert g.points_distance(holed, x, y).tolist() == [0.0, 1.0, 1.0, 0.0]
    assert g.intersects(square, g.read_wkt("LINESTRING (138 35.5, 141 35.5)")) and not g.intersects(square, g.read_wkt("POINT (0 0)"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), min_size=3, max_size=20, unique=True))
def test_hull_holds_its_points(p):
    hull = g.convex_hull(np.array(p))
    xy = np.array(p, dtype=float)
    assert np.allclose(g.points_distance(hull, xy[:, 0], xy[:, 1]), 0, atol=1e-9)


def test_point_columns(spark):
    values = [(139.7, 35.6), (-0.1, 51.5), (0.0, -33.25), (1e-3, 90.0), (179.999999, -1 / 3), (2.0, 8.0)]
    rows = spark.createDataFrame(values, "x double, y double").select("x", "y", points.point_wkb(F.col("x"), F.col("y")).alias("w"), points.geometry_type(points.point_wkb(F.col("x"), F.col("y"))).alias("t"), points.box_wkt(F.col("x"), F.col("y"), F.col("x") + 1, F.col("y") + 1).alias("b")).collect()
    for r in rows:
        assert bytes(r.w) == struct.pack("<BIdd", 1, 1, r.x, r.y) and r.t == "POINT" and g.read_wkt(r.b).envelope()[:2] == (r.x, r.y)
    made = spark.sql("SELECT 'Point(1.5 -2)' AS t UNION ALL SELECT 'x'").select(points.point_from_wkt(F.col("t")).alias("p")).collect()
    assert {(r.p.lon, r.p.lat) if r.p else None for r in made} == {(1.5, -2.0), None}
    ring = spark.sql("SELECT transform(array(array(0d, 0d), array(2d, 0d), array(2d, 3d), array(0d, 0d)), a -> named_struct('lon', a[0], 'lat', a[1])) AS r")
    assert ring.select(points.ring_area(F.col("r")), points.is_closed(F.col("r"))).first()[:] == (3.0, True)


def test_topology(spark):
    t = Topology(spark)
    wkb = lambda s: g.write_wkb(g.read_wkt(s))
    area = lambda w: g.area_m2(g.read_wkb(w)) / 1e6
    one, two = wkb(SQUARE), wkb("POLYGON ((140 35, 141 35, 141 36, 140 36, 140 35))")
    assert area(t.union([one, two])) > 1.9 * area(one)
    bow = wkb("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))")
    assert not t.is_valid(bow) and t.is_valid(t.make_valid(bow))
    for shape in (bow, one, t.make_valid(bow), wkb("POLYGON ((0 0, 1 0, 1 1, 0.5 0.5))")):
        assert g.is_valid(g.read_wkb(shape)) == (shape in (one, t.make_valid(bow)))
    ring = [wkb("LINESTRING (0 0, 4 0, 4 4)"), wkb("LINESTRING (4 4, 0 4, 0 0)")]
    hole = [wkb("LINESTRING (1 1, 2 1, 2 2, 1 2, 1 1)")]
    assert area(t.rings_to_polygon(ring, hole)) < 0.97 * area(t.rings_to_polygon(ring, []))
    assert t.rings_to_polygon(ring[:1], []) is None
    assert t.intersects(one, two) and area(t.buffer(one, 0.1)) > area(one) and len(t.simplify(one, 0.01)) == len(one)
    df = spark.createDataFrame([("a", bytearray(one)), ("a", bytearray(two)), ("b", bytearray(one))], "k string, geometry binary")
    assert {r.k: area(bytes(r.geometry)) > 1.5 * area(one) for r in union_by(df, "k").collect()} == {"a": True, "b": False}
    assert g.intersects(g.read_wkb(one), g.read_wkb(two)) == t.intersects(one, two)


def test_hex_cells(spark):
    df = spark.range(200).selectExpr("122 + id * 0.137 AS lon", "20 + id * 0.093 AS lat").select("*", hexgrid.cell_of(F.col("lon"), F.col("lat"), 7).alias("c"))
    x, y = hexgrid.center(F.col("c"), 7)
    rows = df.select("c", hexgrid.is_cell(F.col("c")).alias("ok"), hexgrid.cell_of(x, y, 7).alias("again"), points.planar_distance(F.col("lon"), F.col("lat"), x, y).alias("d"), hexgrid.resolution_of(F.col("c")).alias("r"), F.transform(hexgrid.disk(F.col("c"), 2, 7), lambda s: hexgrid.distance(F.col("c"), s["cell"]) - s["ring"]).alias("rings"), hexgrid.boundary_wkt(F.col("c"), 7).alias("b")).collect()
    for r in rows:
        assert r.ok and r.again == r.c and r.d <= hexgrid.radius(7) and r.r == 7 and r.rings == [0] * 19
        assert len(g.read_wkt(r.b).coordinates()) == 7
    two = hexgrid.two_resolutions(df.select("c"), "c", 7, 5, "c").groupBy("resolution").count().collect()
    assert {r.resolution: r["count"] for r in two} == {7: 200, 5: 200}
    h3 = spark.sql("SELECT conv('8928308280fffff', 16, 10) AS c").select(F.col("c").cast("long").alias("c"))
    r = h3.select(hexgrid.h3_text(hexgrid.h3_parent(F.col("c"), 8)), hexgrid.h3_text(hexgrid.h3_parent(F.col("c"), 5)), hexgrid.h3_resolution(F.col("c"))).first()
    assert tuple(r) == ("8828308281fffff", "85283083fffffff", 9)


def test_text(spark):
    rows = spark.createDataFrame([("12 m", "1.5 GW", "generation-iv", "https://www.a.example.org/x", "ポケモンセンターX"), ("187", "3 mwp", "v", "http://b.org", "other"), ("x", "3", None, None, None)], "h string, p string, r string, u string, n string")
    found = rows.select(text.height_m(F.col("h")), text.power_mw(F.col("p")), text.roman(F.col("r")), text.publisher_group(F.col("u"), {"example.org": "E"}), text.by_prefix(F.col("n"), F.lit("pokemon_store"), (("ポケモンセンター", "pokemon_center"), ("ポケモンストア", "pokemon_store")))).collect()
    assert [tuple(r) for r in found] == [(12.0, 1500.0, 4, "E", "pokemon_center"), (187.0, 3.0, 5, "b.org", "pokemon_store"), (None, None, None, None, "pokemon_store")]
    seeds = spark.createDataFrame([("https://a.org/1", "https://b.org/2", "two", "x"), ("https://a.org/1", "https://a.org/2", "two", "x"), ("http://a.org", None, "one", ""), ("https://bad.org", None, "none", "x")], "s string, o string, c string, f string")
    bad = seeds.select(text.seed_problems(F.col("s"), F.col("o"), F.col("c"), [F.col("f")], {}, ["bad.org"], ["one", "two"], "two").alias("p")).collect()
    assert [len(r.p) for r in bad] == [0, 1, 2, 2]


def test_relief(spark):
    lats = np.full(9, 35.0)
    flat = relief.hillshade(np.full((9, 9), 100.0), 0.001, 0.001, lats)
    assert abs(int(flat[4, 4]) - 181) <= 1
    ramp = np.add.outer(np.arange(9.0), np.arange(9.0)) * 100
    nw, se = relief.hillshade(ramp, 0.001, 0.001, lats), relief.hillshade(ramp[::-1, ::-1], 0.001, 0.001, lats)
    assert int(nw[4, 4]) - int(se[4, 4]) > 20
    hole = ramp.copy()
    hole[4, 4] = -32767
    assert relief.hillshade(hole, 0.001, 0.001, lats, nodata=-32767)[4, 4] == 0
    assert relief.hillshade(hole, 0.001, 0.001, lats, nodata=-32767)[4, 5] == 0
    rough = np.random.default_rng(1).normal(size=(9, 9)) * 50
    pixels = spark.createDataFrame([(i, j, 35.0, float(rough[i, j])) for i in range(9) for j in range(9)], "row int, col int, lat double, value double")
    for r in relief.hillshade_pixels(pixels, 0.001, 0.001).collect():
        assert abs(r.shade - int(relief.hillshade(rough, 0.001, 0.001, lats)[r.row, r.col])) <= 1


def test_viewshed():
    wall = np.zeros((100, 100))
    wall[:, 50] = 50
    seen = relief.viewshed(wall, 50, 20, 90)
    assert seen[50, 40] == 255 and seen[50, 80] == 0 and seen[50, 20] == 255
    dome = np.fromfunction(lambda r, c: np.minimum(1000, 1600 - 60 * np.hypot(r - 60, c - 60)), (120, 120))
    ring = relief.ring_observers(60, 60, 1000, 8, 90, dome.shape)
    assert len(ring) == 9
    assert (relief.union_viewshed(dome, ring, 90) == 255).mean() > (relief.viewshed(dome, 60, 60, 90) == 255).mean() + 0.2
    dem = np.zeros((50, 50))
    dem[20, 23] = 3776
    xs, ys = np.arange(50) * 10 + 5.0, 500 - np.arange(50) * 10 - 5.0
    assert relief.highest_point(dem, xs, ys, 230, 300, 100) == (235.0, 295.0, 3776.0)


def test_masks_and_mosaics(spark):
    mask = relief.rasterize([g.read_wkt("POLYGON ((1 1, 3 1, 3 3, 1 3, 1 1))")], 0, 4, 1, 1, (4, 4))
    assert mask.tolist() == [[0, 0, 0, 0], [0, 1, 1, 0], [0, 1, 1, 0], [0, 0, 0, 0]]
    t = Topology(spark)
    whole = g.read_wkb(t.union([g.write_wkb(s) for s in relief.outlines(mask, 0, 4, 1, 1)]))
    assert whole.envelope() == (1.0, 1.0, 3.0, 3.0)
    mosaic = np.zeros((3, 3), int)
    relief.paste(mosaic, np.ones((2, 2), int), -1, 2)
    assert mosaic.tolist() == [[0, 0, 1], [0, 0, 0], [0, 0, 0]]
    x, y = relief.utm(np.array([141.0]), np.array([0.0]), 54)
    assert math.isclose(x[0], 500_000) and math.isclose(y[0], 0, abs_tol=1e-6)
    assert relief.bilinear(np.array([[0.0, 1.0], [2.0, 3.0]]), np.array([0.5]), np.array([0.5])).tolist() == [1.5]
