"""Python data sources for binary geodata: shapefile (zipped), geopackage (gzipped or not), GeoTIFF.

Register with ``register(spark)``; then ``spark.read.format("shapefile")`` and so
on. A file is one partition, so many files spread over the cluster. Readers
need paths that Python can open.
"""

from __future__ import annotations

import gzip
import io
import shutil
import sqlite3
import struct
import tempfile
import zipfile
import zlib
from collections.abc import Iterator
from glob import glob
from pathlib import Path

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from meridia.functions.geometry import Geometry, write_wkb


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Files(DataSourceReader):
    """One partition for each file that the path, a file or a pattern, names."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[_File]:
        found = sorted(glob(self.options["path"].removeprefix("file:"))) or [self.options["path"].removeprefix("file:")]
        return [_File(p) for p in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        return self.rows(partition.path)

    def rows(self, path: str) -> Iterator[tuple]:
        raise NotImplementedError


# shapefile --------------------------------------------------------------------------------


def read_dbf(data: bytes, encoding: str = "utf-8") -> tuple[list[str], list[list[str | None]]]:
    """Field names and rows, as trimmed text; blank is null."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields = []
    for at in range(32, head - 1, 32):
        if data[at] == 0x0D:
            break
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii"), data[at + 16]))
    rows = []
    for i in range(n):
        at = head + i * size
        if data[at : at + 1] == b"*":
            rows.append(None)
            continue
        at += 1
        row = []
        for _, width in fields:
            row.append(data[at : at + width].decode(encoding, "replace").strip("\0 ") or None)
            at += width
        rows.append(row)
    return [name for name, _ in fields], rows


def read_shapes(data: bytes) -> list[Geometry | None]:
    """Points, lines and polygons of a .shp file; a polygon's holes follow the shell that holds them."""
    out: list[Geometry | None] = []
    at = 100
    while at < len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        body = data[at + 8 : at + 8 + 2 * words]
        (kind,) = struct.unpack_from("<i", body)
        kind %= 10
        if kind == 1:
            out.append(Geometry("POINT", [[np.frombuffer(body, "<f8", 2, 4).reshape(1, 2)]]))
        elif kind in (3, 5):
            parts, points = struct.unpack_from("<2i", body, 36)
            starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
            xy = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
            rings = [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
            if kind == 3:
                out.append(Geometry("LINESTRING" if parts == 1 else "MULTILINESTRING", [[r] for r in rings]))
            else:
                shells: list[list[np.ndarray]] = []
                for ring in rings:
                    clockwise = np.sum(np.diff(ring[:, 0]) * (ring[1:, 1] + ring[:-1, 1])) > 0
                    if clockwise or not shells:
                        shells.append([ring])
                    else:
                        from meridia.functions.geometry import in_rings

                        home = next((s for s in shells if in_rings(s[:1], ring[:1, 0], ring[:1, 1])[0]), shells[-1])
                        home.append(ring)
                out.append(Geometry("POLYGON" if len(shells) == 1 else "MULTIPOLYGON", shells))
        else:
            out.append(None)
        at += 8 + 2 * words
    return out


def _zip_parts(path: str, member: str | None) -> tuple[bytes, bytes, str]:
    with zipfile.ZipFile(path) as z:
        shp = member or next(n for n in sorted(z.namelist()) if n.lower().endswith(".shp"))
        stem = shp[:-4]
        code = z.read(f"{stem}.cpg").decode().strip() if f"{stem}.cpg" in z.namelist() else "utf-8"
        return z.read(shp), z.read(f"{stem}.dbf"), code


class Shapefile(DataSource):
    """Columns: row (from 1, in file order), one text column for each field, geometry (WKB). Option ``member``."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        path = self.options["path"].removeprefix("file:")
        _, dbf, code = _zip_parts((sorted(glob(path)) or [path])[0], self.options.get("member"))
        names, _ = read_dbf(dbf, code)
        return ", ".join(["row bigint", *(f"`{n}` string" for n in names), "geometry binary"])

    def reader(self, schema) -> DataSourceReader:
        return _ShapefileReader(self.options)


class _ShapefileReader(_Files):
    def rows(self, path: str) -> Iterator[tuple]:
        shp, dbf, code = _zip_parts(path, self.options.get("member"))
        for i, (row, shape) in enumerate(zip(read_dbf(dbf, code)[1], read_shapes(shp), strict=True), 1):
            if row is not None:
                yield (i, *row, write_wkb(shape) if shape else None)


# geopackage -------------------------------------------------------------------------------

#: Doubles in the envelope of a geopackage geometry, by its code.
_ENVELOPES = (0, 4, 6, 6, 8)


def gpkg_wkb(blob: bytes | None) -> bytes | None:
    """The WKB inside a geopackage's geometry."""
    return blob[8 + 8 * _ENVELOPES[blob[3] >> 1 & 7] :] if blob else None


def _open_gpkg(path: str, folder: str) -> sqlite3.Connection:
    if path.endswith(".gz"):
        plain = f"{folder}/{Path(path).stem}"
        with gzip.open(path) as source, open(plain, "wb") as target:
            shutil.copyfileobj(source, target)
        path = plain
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _gpkg_layer(con: sqlite3.Connection, table: str | None) -> tuple[str, str, list[tuple[str, str]]]:
    name, shape = con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns WHERE ? IS NULL OR table_name = ?", (table, table)).fetchone()
    return name, shape, [(c[1], c[2].upper()) for c in con.execute(f'PRAGMA table_info("{name}")')]


class Geopackage(DataSource):
    """The columns of a layer, geometry as WKB. Option ``table``."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> str:
        path = self.options["path"].removeprefix("file:")
        with tempfile.TemporaryDirectory() as folder:
            con = _open_gpkg((sorted(glob(path)) or [path])[0], folder)
            _, shape, columns = _gpkg_layer(con, self.options.get("table"))
            con.close()
        kind = lambda c, t: "binary" if c == shape else "bigint" if "INT" in t else "double" if t in ("REAL", "DOUBLE", "FLOAT") else "string"
        return ", ".join(f"`{c}` {kind(c, t)}" for c, t in columns)

    def reader(self, schema) -> DataSourceReader:
        return _GeopackageReader(self.options)


class _GeopackageReader(_Files):
    def rows(self, path: str) -> Iterator[tuple]:
        with tempfile.TemporaryDirectory() as folder:
            con = _open_gpkg(path, folder)
            name, shape, columns = _gpkg_layer(con, self.options.get("table"))
            at = [c for c, _ in columns].index(shape)
            for row in con.execute(f'SELECT * FROM "{name}"'):
                yield (*row[:at], gpkg_wkb(row[at]), *row[at + 1 :])
            con.close()


# GeoTIFF ----------------------------------------------------------------------------------

#: Bytes of TIFF field types, and numpy kinds of sample formats.
_FIELD = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8)}
_SAMPLE = {1: "u", 2: "i", 3: "f"}


class Raster:
    """Band 1 of a GeoTIFF: values, where its corner lies, the pixel's size in degrees, the empty value."""

    def __init__(self, values: np.ndarray, west: float, north: float, dx: float, dy: float, nodata: float | None = None) -> None:
        self.values, self.west, self.north, self.dx, self.dy, self.nodata = values, west, north, dx, dy, nodata

    def centers(self) -> tuple[np.ndarray, np.ndarray]:
        """Longitudes of columns and latitudes of rows."""
        h, w = self.values.shape
        return self.west + (np.arange(w) + 0.5) * self.dx, self.north - (np.arange(h) + 0.5) * self.dy


def read_geotiff(data: bytes) -> Raster:
    """Striped or tiled, plain or deflated, with or without horizontal predictor."""
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    tags: dict[int, tuple | bytes] = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind not in _FIELD:
            continue
        code, size = _FIELD[kind]
        place = at + 10 + 12 * i
        if size * count > 4:
            (place,) = struct.unpack_from(order + "I", data, place)
        tags[tag] = data[place : place + count] if code == "s" else struct.unpack_from(order + code * count if len(code) == 1 else order + code * count, data, place)
    width, height = tags[256][0], tags[257][0]
    kind = np.dtype(f"{order}{_SAMPLE[tags.get(339, (1,))[0]]}{tags[258][0] // 8}")
    packed, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    if packed not in (1, 8, 32946):
        raise ValueError(f"compression {packed} is not supported")
    tiled = 324 in tags
    tw, th = (tags[322][0], tags[323][0]) if tiled else (width, tags.get(278, (height,))[0])
    offsets, counts = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    out = np.zeros((height, width), dtype=kind.newbyteorder("="))
    across = -(-width // tw)
    for i, (offset, size) in enumerate(zip(offsets, counts, strict=True)):
        chunk = data[offset : offset + size]
        chunk = zlib.decompress(chunk) if packed != 1 else chunk
        y, x = i // across * th, i % across * tw
        rows = th if tiled else min(th, height - y)
        block = np.frombuffer(chunk, dtype=kind, count=rows * tw).reshape(rows, tw)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind)
        out[y : y + rows, x : x + tw] = block[: height - y, : width - x]
    dx, dy = tags[33550][:2]
    col, row, _, west, north, _ = tags[33922][:6]
    empty = tags[42113].split(b"\0")[0] if 42113 in tags else None
    return Raster(out, west - col * dx, north + row * dy, dx, dy, float(empty) if empty else None)


def write_geotiff(r: Raster) -> bytes:
    """One deflated strip."""
    body = zlib.compress(np.ascontiguousarray(r.values.astype(r.values.dtype.newbyteorder("<"))).tobytes())
    height, width = r.values.shape
    form = {"u": 1, "i": 2, "f": 3}[r.values.dtype.kind]
    empty = f"{r.nodata!r}\0".encode() if r.nodata is not None else b""
    entries = [(256, "I", (width,)), (257, "I", (height,)), (258, "H", (r.values.dtype.itemsize * 8,)), (259, "H", (8,)), (262, "H", (1,)), (273, "I", (8,)), (277, "H", (1,)), (278, "I", (height,)), (279, "I", (len(body),)), (339, "H", (form,)), (33550, "d", (r.dx, r.dy, 0.0)), (33922, "d", (0.0, 0.0, 0.0, r.west, r.north, 0.0))]
    if empty:
        entries.append((42113, "s", empty))
    codes = {"H": 3, "I": 4, "d": 12, "s": 2}
    start = 8 + len(body) + len(body) % 2
    extra_at = start + 2 + 12 * len(entries) + 4
    head, extra = io.BytesIO(), io.BytesIO()
    head.write(struct.pack("<H", len(entries)))
    for tag, code, value in entries:
        raw = value if code == "s" else struct.pack(f"<{len(value)}{code}", *value)
        head.write(struct.pack("<HHI", tag, codes[code], len(value)))
        if len(raw) <= 4:
            head.write(raw.ljust(4, b"\0"))
        else:
            head.write(struct.pack("<I", extra_at + extra.tell()))
            extra.write(raw + b"\0" * (len(raw) % 2))
    head.write(b"\0" * 4)
    return struct.pack("<2sHI", b"II", 42, start) + body + b"\0" * (len(body) % 2) + head.getvalue() + extra.getvalue()


class GeoTiff(DataSource):
    """A row for each pixel: file, row, col, lon, lat, value (null where empty)."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return "file string, row int, col int, lon double, lat double, value double"

    def reader(self, schema) -> DataSourceReader:
        return _GeoTiffReader(self.options)


class _GeoTiffReader(_Files):
    def rows(self, path: str) -> Iterator[tuple]:
        r = read_geotiff(Path(path).read_bytes())
        lons, lats = r.centers()
        for i, line in enumerate(r.values.astype(float).tolist()):
            for j, v in enumerate(line):
                yield path, i, j, float(lons[j]), float(lats[i]), None if v == r.nodata or v != v else v


def register(spark: SparkSession) -> None:
    for source in (Shapefile, Geopackage, GeoTiff):
        spark.dataSource.register(source)
