"""Features in XML formats: KML, GML, GPX, OSM, GeoRSS and Atom, read and (but for OSM) written.

A document is one column value; reading gives array<struct<id, name, kind, points>> with points as (x: lng, y: lat).
Elements are found by their local name, whatever the namespace prefix. Documents that do not parse give null.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FEATURES = "array<struct<id: string, name: string, kind: string, points: array<struct<x: double, y: double>>>>"


def local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2].rpartition(":")[2]


def all_of(e: ElementTree.Element, *names: str) -> Iterator[ElementTree.Element]:
    return (x for x in e.iter() if local(x) in names)


def first_text(e: ElementTree.Element, *names: str) -> str | None:
    return next((x.text.strip() for x in all_of(e, *names) if x.text), None)


def identity(e: ElementTree.Element) -> str | None:
    return next((v for k, v in e.attrib.items() if k.rpartition("}")[2] in ("id", "fid")), None)


def numbers(text: str | None) -> list[float]:
    return [float(v) for v in (text or "").replace(",", " ").split()]


def tuples(text: str | None) -> list[tuple[float, float]]:
    """Comma-joined coordinates parted by white space; a third one is left out."""
    return [(float(p.split(",")[0]), float(p.split(",")[1])) for p in (text or "").split()]


def turned(values: list[float]) -> list[tuple[float, float]]:
    """Latitudes and longitudes in turn as (lng, lat)."""
    return list(zip(values[1::2], values[::2], strict=True))


def kml(root: ElementTree.Element) -> Iterator[tuple]:
    for mark in all_of(root, "Placemark"):
        for g in all_of(mark, "Point", "LineString", "LinearRing"):
            yield identity(mark), first_text(mark, "name"), local(g), tuples(first_text(g, "coordinates"))


def gml(root: ElementTree.Element) -> Iterator[tuple]:
    """Coordinates as x, y, in one of the three forms of the format."""
    for member in all_of(root, "featureMember"):
        for g in all_of(member, "Point", "LineString", "LinearRing"):
            xy = numbers(first_text(g, "pos", "posList"))
            points = list(zip(xy[::2], xy[1::2], strict=True)) if xy else tuples(first_text(g, "coordinates"))
            yield identity(next(iter(member), member)), first_text(member, "name"), local(g), points


def gpx(root: ElementTree.Element) -> Iterator[tuple]:
    place = lambda e: (float(e.get("lon")), float(e.get("lat")))
    for e in all_of(root, "wpt"):
        yield None, first_text(e, "name"), "Point", [place(e)]
    for e in all_of(root, "rte"):
        yield None, first_text(e, "name"), "LineString", [place(p) for p in all_of(e, "rtept")]
    for trk in all_of(root, "trk"):
        for e in all_of(trk, "trkseg"):
            yield None, first_text(trk, "name"), "LineString", [place(p) for p in all_of(e, "trkpt")]


def osm(root: ElementTree.Element) -> Iterator[tuple]:
    """Ways, then the nodes that no way has; a way that ends where it began is a ring."""
    nodes = {e.get("id"): (float(e.get("lon")), float(e.get("lat"))) for e in all_of(root, "node")}
    name = lambda e: next((t.get("v") for t in all_of(e, "tag") if t.get("k") == "name"), None)
    used = set()
    for way in all_of(root, "way"):
        refs = [r.get("ref") for r in all_of(way, "nd") if r.get("ref") in nodes]
        used.update(refs)
        yield way.get("id"), name(way), "LinearRing" if len(refs) > 3 and refs[0] == refs[-1] else "LineString", [nodes[r] for r in refs]
    for e in all_of(root, "node"):
        if e.get("id") not in used:
            yield e.get("id"), name(e), "Point", [nodes[e.get("id")]]


def georss(root: ElementTree.Element) -> Iterator[tuple]:
    """Places of items and entries: simple, or latitude and longitude elements."""
    kinds = {"point": "Point", "line": "LineString", "polygon": "LinearRing"}
    for item in all_of(root, "item", "entry"):
        name, id_ = first_text(item, "title"), first_text(item, "guid", "id")
        lat, lng = first_text(item, "lat"), first_text(item, "long", "lon")
        if lat and lng:
            yield id_, name, "Point", [(float(lng), float(lat))]
        for g in all_of(item, *kinds):
            yield id_, name, kinds[local(g)], turned(numbers(g.text))


READERS = {"kml": kml, "gml": gml, "gpx": gpx, "osm": osm, "georss": georss, "atom": georss}


def read(text: Column, form: str) -> Column:
    """FEATURES of documents in a form of READERS."""
    find = READERS[form]

    @F.pandas_udf(FEATURES)
    def run(col: pd.Series) -> pd.Series:
        out = []
        for t in col:
            try:
                out.append(None if t is None else [{"id": i, "name": n, "kind": k, "points": [{"x": x, "y": y} for x, y in p]} for i, n, k, p in find(ElementTree.fromstring(t))])
            except (ElementTree.ParseError, ValueError, TypeError, IndexError):
                out.append(None)
        return pd.Series(out, dtype=object)

    return run(text)


def escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _list(points: Column, part: str, between: str, swap: bool = False) -> Column:
    a, b = ("y", "x") if swap else ("x", "y")
    return F.array_join(F.transform(points, lambda p: F.concat(p[a].cast("string"), F.lit(part), p[b].cast("string"))), between)


def _joined(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def write(id_: Column, name: Column, points: Column, form: str) -> Column:
    """A document with one feature: a point, or a line of several points."""
    id_, name, one = escaped(id_.cast("string")), escaped(name), F.size(points) == 1
    kind = F.when(one, "Point").otherwise("LineString")
    if form == "kml":
        return _joined('<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark id="', id_, '"><name>', name, "</name><", kind, "><coordinates>", _list(points, ",", " "), "</coordinates></", kind, "></Placemark></Document></kml>")
    if form == "gml":
        tag = F.when(one, "pos").otherwise("posList")
        return _joined('<gml:FeatureCollection xmlns:gml="http://www.opengis.net/gml"><gml:featureMember><feature fid="', id_, '"><gml:name>', name, "</gml:name><gml:", kind, "><gml:", tag, ">", _list(points, " ", " "), "</gml:", tag, "></gml:", kind, "></feature></gml:featureMember></gml:FeatureCollection>")
    if form == "gpx":
        each = lambda tag: F.array_join(F.transform(points, lambda p: _joined(f'<{tag} lat="', p["y"].cast("string"), '" lon="', p["x"].cast("string"), '">')), "" if tag == "wpt" else f"</{tag}>")
        body = F.when(one, _joined(each("wpt"), "<name>", name, "</name></wpt>")).otherwise(_joined("<rte><name>", name, "</name>", each("rtept"), "</rtept></rte>"))
        return _joined('<gpx version="1.1" xmlns="http://www.topografix.com/GPX/1/1">', body, "</gpx>")
    tag = F.when(one, "point").otherwise("line")
    place = _joined("<georss:", tag, ">", _list(points, " ", " ", swap=True), "</georss:", tag, ">")
    if form == "georss":
        return _joined('<rss version="2.0" xmlns:georss="http://www.georss.org/georss"><channel><item><guid>', id_, "</guid><title>", name, "</title>", place, "</item></channel></rss>")
    if form == "atom":
        return _joined('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:georss="http://www.georss.org/georss"><entry><id>', id_, "</id><title>", name, "</title>", place, "</entry></feed>")
    raise ValueError(f"{form} is not written")
