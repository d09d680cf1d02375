"""Feature formats: GeoJSON, WKT, delimited text, encoded polylines, query strings."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTS = "array<struct<x: double, y: double>>"
_GEOJSON = "struct<type: string, features: array<struct<id: string, properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>>"


def geojson(text: Column) -> Column:
    """array<struct<id, properties, kind, rings: array<POINTS>>> of a feature collection; points and lines are one ring."""
    fc = F.from_json(text, _GEOJSON)

    def rings(g: Column) -> Column:
        to_points = lambda a: F.transform(a, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
        return (
            F.when(g["type"] == "Point", F.array(to_points(F.array(F.from_json(g["coordinates"], "array<double>")))))
            .when(g["type"].isin("LineString", "MultiPoint"), F.array(to_points(F.from_json(g["coordinates"], "array<array<double>>"))))
            .when(g["type"].isin("Polygon", "MultiLineString"), F.transform(F.from_json(g["coordinates"], "array<array<array<double>>>"), to_points))
        )

    return F.transform(fc["features"], lambda f: F.struct(f["id"].alias("id"), f["properties"].alias("properties"), f["geometry"]["type"].alias("kind"), rings(f["geometry"]).alias("rings")))


def to_geojson(id_: Column, polygon: Column) -> Column:
    """A polygon feature as JSON, its ring closed."""
    ring = F.transform(F.concat(polygon, F.slice(polygon, 1, 1)), lambda p: F.array(p["x"], p["y"]))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), id_.cast("string").alias("id"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")))


def wkt(text: Column) -> Column:
    """struct(kind, rings) of POINT, MULTIPOINT, LINESTRING, MULTILINESTRING, POLYGON texts; rings null if malformed."""
    kind = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    body = F.regexp_extract(text, r"^\s*[A-Za-z]+\s*\((.*)\)\s*$", 1)
    parts = F.when(kind.isin("POLYGON", "MULTILINESTRING"), F.split(F.regexp_replace(body, r"^\s*\(|\)\s*$", ""), r"\)\s*,\s*\(")).otherwise(F.array(F.regexp_replace(body, r"[()]", "")))

    def point(p: Column) -> Column:
        xy = F.split(F.trim(p), r"\s+")
        return F.struct(F.try_element_at(xy, F.lit(1)).try_cast("double").alias("x"), F.try_element_at(xy, F.lit(2)).try_cast("double").alias("y"))

    rings = F.transform(parts, lambda r: F.transform(F.split(r, ","), point))
    ok = (body != "") & ~F.exists(F.flatten(rings), lambda p: p["x"].isNull() | p["y"].isNull())
    return F.struct(kind.alias("kind"), F.when(ok, rings).alias("rings"))


def to_wkt(polygon: Column) -> Column:
    pts = F.transform(F.concat(polygon, F.slice(polygon, 1, 1)), lambda p: F.concat_ws(" ", p["x"], p["y"]))
    return F.concat(F.lit("POLYGON(("), F.array_join(pts, ","), F.lit("))"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated features with a header; lat and lon (or point "lat,lon") become doubles."""
    t = spark.read.option("header", True).option("sep", "\t").csv(path)
    if "point" in t.columns:
        p = F.split("point", ",")
        t = t.withColumns({"lat": p[0], "lon": p[1]}).drop("point")
    return t.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lon") if c in t.columns})


def decode_polyline(text: str, factor: float = 1e5) -> list[tuple[float, float]]:
    """(lat, lng) points of an encoded polyline: zigzag deltas in base 32, 63 added to each digit."""
    values, shift, value = [], 0, 0
    for c in text:
        d = ord(c) - 63
        value |= (d & 31) << shift
        shift += 5
        if d < 32:
            values.append(~(value >> 1) if value & 1 else value >> 1)
            value = shift = 0
    lat = pd.Series(values[::2], dtype=float).cumsum() / factor
    return list(zip(lat, pd.Series(values[1::2], dtype=float).cumsum() / factor, strict=True))


def encode_polyline(points: list[tuple[float, float]], factor: float = 1e5) -> str:
    out, before = [], (0, 0)
    for p in points:
        now = tuple(round(v * factor) for v in p)
        for a, b in zip(now, before, strict=True):
            v = (a - b) << 1
            v = ~v if a < b else v
            while v >= 32:
                out.append(chr((v & 31 | 32) + 63))
                v >>= 5
            out.append(chr(v + 63))
        before = now
    return "".join(out)


def polyline(text: Column) -> Column:
    """The points of encoded polylines."""

    @F.pandas_udf(POINTS)
    def run(col: pd.Series) -> pd.Series:
        return col.map(lambda t: [{"x": lng, "y": lat} for lat, lng in decode_polyline(t)] if t is not None else None)

    return run(text)


def query_string(filters: dict) -> str:
    """A simple filter tree (see plans.cql) as key__op=value pairs; only comparisons joined by AND have a form."""
    names = {"=": "eq", "<>": "ne", "<": "lt", "<=": "lte", ">": "gt", ">=": "gte", "LIKE": "ilike"}
    if filters["op"] == "AND":
        return "&".join(query_string(f) for f in filters["args"])
    return f"{filters['name']}__{names[filters['op']]}={re.sub(r'[*]', '%', str(filters['value']))}"
