"""Readers of raw formats as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.functions import geometry

#: An element of the map API: tags stay a map, since they differ from one element to the next.
ELEMENT = "array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,geometry:array<struct<lat:double,lon:double>>,tags:map<string,string>,members:array<struct<type:string,ref:bigint,role:string,geometry:array<struct<lat:double,lon:double>>>>>>"


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A CSV file with a header, all columns text, empty fields null."""
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, inferSchema=False, multiLine=True, quote='"', escape='"', encoding="UTF-8")


def read_elements(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Elements of map documents: category (the file's folder), key (type/id), and the element's fields."""
    raw = spark.read.text(list(paths), wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    each = raw.select(F.regexp_extract("file", r"/([a-z_]+)/[a-z_]+\.json$", 1).alias("category"), F.explode(F.from_json("value", f"elements {ELEMENT}")["elements"]).alias("e"))
    return each.select("category", F.concat_ws("/", "e.type", "e.id").alias("key"), "e.*")


def tag(name: str) -> Column:
    """A tag's trimmed text; blank is null."""
    return F.nullif(F.trim(F.col("tags")[name]), F.lit(""))


def element_point() -> Column:
    """struct(lon, lat): the node's own, or the centre of a way or relation."""
    lon, lat = F.coalesce("lon", "center.lon"), F.coalesce("lat", "center.lat")
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def read_bindings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of SPARQL results: entity addresses become their last part, what is not bound is null."""
    value = "struct<type:string,value:string>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"results struct<bindings:array<map<string,{value}>>>")["results"]["bindings"].alias("rows"))
    each = raw.select(F.explode("rows").alias("r"))
    text = lambda c: F.col("r")[c]["value"]
    short = lambda c: F.when((F.col("r")[c]["type"] == "uri") & text(c).contains("/entity/"), F.element_at(F.split(text(c), "/"), -1)).otherwise(text(c))
    return each.select(*(short(c).alias(c) for c in columns))


def read_json_value(spark: SparkSession, path: str, place: str) -> DataFrame:
    """file, value: one value of each JSON document."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.get_json_object("value", place).alias("value"))


def read_geojson(spark: SparkSession, path: str, properties: Sequence[str]) -> DataFrame:
    """Features of a collection: the wanted properties as text, and geometry as WKB."""
    raw = spark.read.text(path, wholetext=True)
    each = raw.select(F.explode(F.from_json("value", "features array<string>")["features"]).alias("f"))
    return each.select(*(F.get_json_object("f", f"$.properties['{p}']").alias(p) for p in properties), F.get_json_object("f", "$.geometry").alias("g")).withColumn("geometry", geometry.wkb_from_geojson("g")).drop("g")


def rows(spark: SparkSession, columns: Sequence[str], values: Sequence[Sequence]) -> DataFrame:
    """Values as a table of text columns."""
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in values], ", ".join(f"`{c}` string" for c in columns))
