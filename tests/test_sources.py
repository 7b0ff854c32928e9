import gzip
import json
import sqlite3
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridia.functions import geometry as g
from meridia.sources import bronze, files, readers


def write_shapefile(path, rows, fields):
    """Zipped shapefile of polygons: (values, geometry)."""
    shp, records = b"", b""
    for i, (_, shape) in enumerate(rows, 1):
        rings = [np.asarray(r)[::-1] for p in shape.parts for r in p]  # shells clockwise, holes not
        xy = np.concatenate(rings)
        body = struct.pack("<i4d2i", 5, *shape.envelope(), len(rings), len(xy)) + struct.pack(f"<{len(rings)}i", *np.cumsum([0, *map(len, rings[:-1])])) + xy.astype("<f8").tobytes()
        records += struct.pack(">2i", i, len(body) // 2) + body
    shp = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(records)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + records
    width = 20
    head = b"".join(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width]) + b"\0" * 15 for n in fields)
    dbf = struct.pack("<4BIHH20x", 3, 26, 1, 1, len(rows), 32 + len(head) + 1, 1 + width * len(fields)) + head + b"\r"
    dbf += b"".join(b" " + b"".join((v or "").encode()[:width].ljust(width) for v in values) for values, _ in rows)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("layer.shp", shp)
        z.writestr("layer.dbf", dbf)


HOLED = g.read_wkt("POLYGON ((139 35, 140 35, 140 36, 139 36, 139 35), (139.2 35.2, 139.2 35.4, 139.4 35.4, 139.4 35.2, 139.2 35.2))")


def test_shapefile(spark, tmp_path):
    files.register(spark)
    write_shapefile(tmp_path / "a.zip", [(("JP-13", "東京"), HOLED), (("JP-27", None), g.read_wkt("POLYGON ((1 1, 2 1, 2 2, 1 1))"))], ["iso", "name"])
    rows = spark.read.format("shapefile").load(str(tmp_path / "a.zip")).orderBy("row").collect()
    assert [(r.row, r.iso, r.name) for r in rows] == [(1, "JP-13", "東京"), (2, "JP-27", None)]
    assert len(g.read_wkb(rows[0].geometry).parts[0]) == 2 and g.area_m2(g.read_wkb(rows[0].geometry)) == pytest.approx(g.area_m2(HOLED))


def test_geopackage(spark, tmp_path):
    files.register(spark)
    path = tmp_path / "p.gpkg"
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('cells', 'geom')")
    con.execute("CREATE TABLE cells (fid INTEGER, geom BLOB, h3 TEXT, population REAL)")
    wkb = g.write_wkb(HOLED)
    con.executemany("INSERT INTO cells VALUES (?, ?, ?, ?)", [(1, b"GP\0\x03" + struct.pack("<i4d", 4326, *HOLED.envelope()) + wkb, "a", 100.0), (2, None, "b", 50.0)])
    con.commit()
    con.close()
    (tmp_path / "p.gpkg.gz").write_bytes(gzip.compress(path.read_bytes()))
    for name in ("p.gpkg", "p.gpkg.gz"):
        rows = spark.read.format("geopackage").load(str(tmp_path / name)).orderBy("fid").collect()
        assert [(r.h3, r.population, r.geom and bytes(r.geom) == wkb) for r in rows] == [("a", 100.0, True), ("b", 50.0, None)]


@pytest.mark.parametrize("kind", ["f4", "u1", "i2"])
def test_geotiff(spark, tmp_path, kind):
    files.register(spark)
    values = np.arange(12).reshape(3, 4).astype(kind)
    (tmp_path / "r.tif").write_bytes(files.write_geotiff(files.Raster(values, 139.0, 36.0, 0.5, 0.25, 5.0)))
    back = files.read_geotiff((tmp_path / "r.tif").read_bytes())
    assert (back.values == values).all() and (back.west, back.north, back.dx, back.dy, back.nodata) == (139.0, 36.0, 0.5, 0.25, 5.0)
    rows = spark.read.format("geotiff").load(str(tmp_path / "r.tif")).orderBy("row", "col").collect()
    assert [r.value for r in rows] == [None if v == 5 else float(v) for v in range(12)]
    assert (rows[0].lon, rows[0].lat) == (139.25, 35.875)


def test_elements_and_bindings(spark, tmp_path):
    (tmp_path / "onsen").mkdir()
    doc = {"elements": [{"type": "node", "id": 1, "lat": 35.0, "lon": 139.0, "tags": {"name:ja": " 湯 ", "name": "x"}}, {"type": "way", "id": 2, "center": {"lat": 36.0, "lon": 140.0}, "tags": {"name": " "}}]}
    (tmp_path / "onsen" / "box.json").write_text(json.dumps(doc))
    rows = readers.read_elements(spark, [str(tmp_path / "onsen" / "box.json")]).select("category", "key", readers.tag("name:ja"), readers.tag("name"), readers.element_point().alias("p")).orderBy("key").collect()
    assert [tuple(r)[:4] for r in rows] == [("onsen", "node/1", "湯", "x"), ("onsen", "way/2", None, None)] and (rows[1].p.lon, rows[1].p.lat) == (140.0, 36.0)
    (tmp_path / "q.json").write_text(json.dumps({"results": {"bindings": [{"a": {"type": "uri", "value": "http://w.org/entity/Q1"}, "b": {"type": "literal", "value": "x/entity/y"}}, {"b": {"type": "literal", "value": "z"}}]}}))
    assert [tuple(r) for r in readers.read_bindings(spark, str(tmp_path / "q.json"), ["a", "b"]).collect()] == [("Q1", "x/entity/y"), (None, "z")]
    (tmp_path / "s.csv").write_text('a,b\n1,"x, ""y"""\n,"line\ntwo"\n', encoding="utf-8")
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "s.csv")).collect()] == [("1", 'x, "y"'), (None, "line\ntwo")]
    (tmp_path / "f.geojson").write_text(json.dumps({"features": [{"properties": {"name": "A"}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]}))
    r = readers.read_geojson(spark, str(tmp_path / "f.geojson"), ["name"]).first()
    assert r.name == "A" and g.write_wkt(g.read_wkb(r.geometry)) == "POINT (1.0 2.0)"
    (tmp_path / "r.json").write_text(json.dumps({"main_generation": {"name": "generation-ix"}}))
    assert readers.read_json_value(spark, str(tmp_path / "r.json"), "$.main_generation.name").first().value == "generation-ix"
    assert readers.rows(spark, ["a"], [[1], [None]]).where(F.col("a").isNull()).count() == 1


def test_bronze(tmp_path):
    for run, text in (("20260101T000000Z", "one"), ("20260102T000000Z", "one")):
        folder = tmp_path / "bronze" / "src" / f"run_id={run}"
        (folder / "lids").mkdir(parents=True)
        with pytest.raises(bronze.BronzeError):
            bronze.Bronze(tmp_path, run).folder("src")
        if run.endswith("2T000000Z"):
            assert bronze.reuse(tmp_path, "src", run, "lids/a.json")["reused_from"] == "20260101T000000Z"
        else:
            (folder / "lids" / "a.json").write_text(text)
        told = bronze.close_run(tmp_path, "src", run, [{"path": "lids/a.json"}])
    assert told["unchanged_vs_previous"] and told["previous_run_id"] == "20260101T000000Z"
    b = bronze.Bronze(tmp_path, "20260102T000000Z")
    assert len(b.by_category("src", ["lids"])) == 1
    with pytest.raises(bronze.BronzeError, match="other"):
        b.by_category("src", ["lids", "other"])
    assert bronze.run_report([told])["files"] == 1
    (tmp_path / "bad.zip").write_bytes(b"no")
    (tmp_path / "cut.gz").write_bytes(gzip.compress(b"x" * 10_000)[:-8])
    for name in ("bad.zip", "cut.gz"):
        with pytest.raises(bronze.BronzeError):
            bronze.check_file(tmp_path / name)


def test_planning():
    assert bronze.degree_tiles((35.1, 138.5, 35.9, 138.9)) == ["N35_E138"]
    assert bronze.degree_tiles((-1.5, -0.5, -1.2, 0.5)) == ["S02_W001", "S02_E000"]
    assert len(bronze.degree_tiles((33, 136, 38, 141))) == 25
    assert bronze.tile_box("h31v05") == (30, 130, 40, 140)
    assert bronze.select_tiles(["a.h31v05.h5", "x"], r"a\.(h\d+v\d+)\.h5", ["h31v05"]) == {"h31v05": "a.h31v05.h5"}
    for listing in ([], ["a.h31v05.h5"] * 2):
        with pytest.raises(bronze.BronzeError):
            bronze.select_tiles(listing, r"a\.(h\d+v\d+)\.h5", ["h31v05"])
    q = bronze.box_query(['node["a"="b"]'], "center", 180, box=(35, 139, 36, 140), date="2026-01-01T00:00:00Z")
    assert q == '[out:json][timeout:180][date:"2026-01-01T00:00:00Z"];(node["a"="b"](35,139,36,140););out center;'
    with pytest.raises(ValueError):
        bronze.box_query([], "center", 1)
    assert bronze.plan_queries({"a": ["all"], "b": ["x"]}, {"x": (), "y": ()}) == [("a", "x"), ("a", "y"), ("b", "x")]
    assert bronze.check_response('{"osm3s": {"timestamp_osm_base": "t"}, "elements": []}') == {"osm3s": {}, "elements": []}
    for text in ('{"elements": [', '{"remark": "runtime error: Query timed out", "elements": []}'):
        with pytest.raises(bronze.BronzeError):
            bronze.check_response(text)


def test_full_coordinates_in_a_query():
    from meridia.sources import bronze

    assert "(around:500,35.658034,139.701636)" in bronze.box_query(["node"], "geom", 60, around=(500, 35.658034, 139.701636))
