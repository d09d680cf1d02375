"""Image and map coordinates, polygons, and the geometry of features.

Polygons are array<struct<x: double, y: double>> with an implicit last edge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 radii in km; spherical radius and the Vincenty ellipsoid in m.
WGS84_A, WGS84_B = 6378.1370, 6356.7523142
SPHERE, ELLIPSOID_A, ELLIPSOID_B, FLATTENING = 6378137.0, 6378137.0, 6356752.3142, 1 / 298.257223563


def lnglat(px: Column, py: Column, width: float, height: float, points: Mapping[str, Column | float]) -> Column:
    """One coordinate of a pixel from its values at nine points tl tm tr ml mm mr bl bm br, to second order."""
    p = {k: v if isinstance(v, Column) else F.lit(float(v)) for k, v in points.items()}
    x, y = (px - width / 2) / width, (py - height / 2) / height
    return p["mm"] + x * (p["mr"] - p["ml"]) + y * (p["tm"] - p["bm"]) + x * x * 2 * (p["mr"] - 2 * p["mm"] + p["ml"]) + y * y * 2 * (p["tm"] - 2 * p["mm"] + p["bm"]) + x * y * (p["tr"] - p["br"] - p["tl"] + p["bl"])


def meters(lng: Column, lat: Column, lng0: Column, lat0: Column) -> tuple[Column, Column]:
    """Metres east and north of a centre."""
    e2 = (WGS84_A**2 - WGS84_B**2) / WGS84_A**2
    p = F.radians(lat0)
    bulge = 1 - e2 * F.pow(F.sin(p), F.lit(2.0))
    east = F.lit(np.pi * WGS84_A / 180) * F.cos(p) / F.sqrt(bulge)
    north = F.lit(np.pi * WGS84_A * (1 - e2) / 180) / F.pow(bulge, F.lit(1.5))
    return (lng - lng0) * east * 1000, (lat - lat0) * north * 1000


def _edges(polygon: Column, f) -> Column:
    following = F.concat(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.slice(polygon, 1, 1))
    return F.aggregate(F.zip_with(polygon, following, f), F.lit(0.0), lambda a, v: a + v)


def area(polygon: Column) -> Column:
    return _edges(polygon, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]) * 0.5


def perimeter(polygon: Column) -> Column:
    return _edges(polygon, lambda p, q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])))


def centroid(polygon: Column) -> Column:
    """struct(x, y); null parts when the area is 0."""
    six = F.nullif(area(polygon) * 6, F.lit(0.0))
    part = lambda c: _edges(polygon, lambda p, q: (p[c] + q[c]) * (p["x"] * q["y"] - q["x"] * p["y"])) / six
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def moved(polygon: Column, f) -> Column:
    """The polygon with f(x, y) -> (x, y) on every vertex: moving, turning, scaling, transforming."""
    return F.transform(polygon, lambda p: F.struct(f(p["x"], p["y"])[0].alias("x"), f(p["x"], p["y"])[1].alias("y")))


def rotated(polygon: Column, angle: float, x0: float, y0: float) -> Column:
    c, s = float(np.cos(np.radians(angle))), float(np.sin(np.radians(angle)))
    return moved(polygon, lambda x, y: (x0 + (x - x0) * c - (y - y0) * s, y0 + (x - x0) * s + (y - y0) * c))


def resized(polygon: Column, scale: float, x0: float, y0: float, ratio: float = 1.0) -> Column:
    return moved(polygon, lambda x, y: (x0 + scale * ratio * (x - x0), y0 + scale * (y - y0)))


def regular_polygon(x: Column, y: Column, radius: Column, sides: int, rotation: float = 0.0) -> Column:
    at = lambda i: F.lit(np.pi) * (1.0 / sides - 0.5) + i * 2 * np.pi / sides + np.radians(rotation)
    return F.transform(F.sequence(F.lit(0), F.lit(sides - 1)), lambda i: F.struct((x + radius * F.cos(at(i))).alias("x"), (y + radius * F.sin(at(i))).alias("y")))


def bounds(polygon: Column) -> Column:
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("left"), F.array_min(ys).alias("bottom"), F.array_max(xs).alias("right"), F.array_max(ys).alias("top"))


def contains(polygon: Column, x: Column, y: Column) -> Column:
    """Even-odd rule by crossings of a ray; a vertex or an edge point belongs to the polygon."""
    following = F.concat(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.slice(polygon, 1, 1))
    edges = F.zip_with(polygon, following, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    cross = lambda e: (e["p"]["y"] > y) != (e["q"]["y"] > y)
    at = lambda e: (e["q"]["x"] - e["p"]["x"]) * (y - e["p"]["y"]) / (e["q"]["y"] - e["p"]["y"]) + e["p"]["x"]
    on = lambda e: ((e["q"]["x"] - e["p"]["x"]) * (y - e["p"]["y"]) == (e["q"]["y"] - e["p"]["y"]) * (x - e["p"]["x"])) & x.between(F.least(e["p"]["x"], e["q"]["x"]), F.greatest(e["p"]["x"], e["q"]["x"])) & y.between(F.least(e["p"]["y"], e["q"]["y"]), F.greatest(e["p"]["y"], e["q"]["y"]))
    odd = F.size(F.filter(edges, lambda e: F.when(cross(e), x < at(e)).otherwise(F.lit(False)))) % 2 == 1
    return F.exists(edges, on) | odd


def corner_lnglat(corners: DataFrame, width: float, height: float, lng: Mapping, lat: Mapping) -> DataFrame:
    """corners(image_key, left_x, left_y, ...) of raster.corners as left_lng, left_lat, ... from the image's nine points."""
    at = lambda side, points: lnglat(F.col(f"{side}_x"), F.col(f"{side}_y"), width, height, points)
    return corners.select("image_key", *[at(s, p).alias(f"{s}_{n}") for s in ("left", "top", "right", "bottom") for n, p in (("lng", lng), ("lat", lat))])


def area_with_holes(rings: Column) -> Column:
    """Area of array<polygon>: the outer ring less the holes."""
    size = F.transform(rings, lambda r: F.abs(area(r)))
    return F.coalesce(F.get(size, F.lit(0)) * 2, F.lit(0.0)) - F.aggregate(size, F.lit(0.0), lambda a, v: a + v)


def contains_with_holes(rings: Column, x: Column, y: Column) -> Column:
    """Whether a point is in the outer ring and in no hole."""
    holes = F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0)))
    return contains(F.get(rings, F.lit(0)), x, y) & ~F.exists(holes, lambda r: contains(r, x, y))


def _pairs(line: Column) -> Column:
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.zip_with(F.slice(line, 1, n), F.slice(line, 2, n), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def length(line: Column) -> Column:
    """Length of an open line."""
    step = lambda e: F.sqrt(F.pow(e["p"]["x"] - e["q"]["x"], F.lit(2.0)) + F.pow(e["p"]["y"] - e["q"]["y"], F.lit(2.0)))
    return F.aggregate(_pairs(line), F.lit(0.0), lambda a, e: a + step(e))


def geodesic_length_km(line: Column) -> Column:
    """Great-circle length of a line of (lng, lat) points."""
    return F.aggregate(_pairs(line), F.lit(0.0), lambda a, e: a + haversine_km(e["p"]["x"], e["p"]["y"], e["q"]["x"], e["q"]["y"]))


def segment_distance(x: Column, y: Column, p: Column, q: Column) -> Column:
    """Distance of a point from the segment from p to q."""
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]
    t = F.coalesce(((x - p["x"]) * dx + (y - p["y"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.sqrt(F.pow(x - p["x"] - t * dx, F.lit(2.0)) + F.pow(y - p["y"] - t * dy, F.lit(2.0)))


def line_distance(line: Column, x: Column, y: Column) -> Column:
    """Least distance of a point from a line; from a polygon's edge if its ring is closed."""
    return F.array_min(F.transform(_pairs(line), lambda e: segment_distance(x, y, e["p"], e["q"])))


def closed(ring: Column) -> Column:
    """The ring as a line that returns to its first point."""
    return F.concat(ring, F.slice(ring, 1, 1))


def polygon_distance(rings: Column, x: Column, y: Column) -> Column:
    """Distance of a point from a polygon with holes: 0 inside."""
    edge = F.array_min(F.transform(rings, lambda r: line_distance(closed(r), x, y)))
    return F.when(contains_with_holes(rings, x, y), F.lit(0.0)).otherwise(edge)


def crossing(a: Column, b: Column) -> Column:
    """struct(x, y) where two segments struct(p, q) cross, or null; parallel ones do not."""
    dx1, dy1 = a["q"]["x"] - a["p"]["x"], a["q"]["y"] - a["p"]["y"]
    dx2, dy2 = b["q"]["x"] - b["p"]["x"], b["q"]["y"] - b["p"]["y"]
    d = F.nullif(dx1 * dy2 - dy1 * dx2, F.lit(0.0))
    t = ((b["p"]["x"] - a["p"]["x"]) * dy2 - (b["p"]["y"] - a["p"]["y"]) * dx2) / d
    u = ((b["p"]["x"] - a["p"]["x"]) * dy1 - (b["p"]["y"] - a["p"]["y"]) * dx1) / d
    return F.when(t.between(0, 1) & u.between(0, 1), F.struct((a["p"]["x"] + t * dx1).alias("x"), (a["p"]["y"] + t * dy1).alias("y")))


def crossings(line: Column, other: Column) -> Column:
    """All points in which two lines cross."""
    each = F.flatten(F.transform(_pairs(line), lambda a: F.transform(_pairs(other), lambda b: crossing(a, b))))
    return F.filter(each, lambda p: p.isNotNull())


def rings_intersect(ring: Column, other: Column) -> Column:
    """Whether two rings share a point: edges cross, or one holds the other."""
    first = lambda r: F.get(r, F.lit(0))
    inside = contains(ring, first(other)["x"], first(other)["y"]) | contains(other, first(ring)["x"], first(ring)["y"])
    return inside | (F.size(crossings(closed(ring), closed(other))) > 0)


def split_line(points: Sequence[tuple[float, float]], by: Sequence[tuple[float, float]]) -> list[list[tuple[float, float]]]:
    """The parts into which a line falls where another crosses it."""
    parts, part = [], [tuple(points[0])]
    for a, b in zip(points, points[1:], strict=False):
        cuts = {c for p, q in zip(by, by[1:], strict=False) if (c := segments_intersect((*a, *b), (*p, *q)))}
        for c in sorted(cuts, key=lambda c: (c[0] - a[0]) ** 2 + (c[1] - a[1]) ** 2):
            if c != part[-1]:
                part.append(c)
            if len(part) > 1:
                parts.append(part)
            part = [c]
        if tuple(b) != part[-1]:
            part.append(tuple(b))
    return parts + [part] * (len(part) > 1)


def split(line: Column, by: Column) -> Column:
    """split_line over columns of points: array<array<struct<x, y>>>."""

    @F.pandas_udf("array<array<struct<x: double, y: double>>>")
    def run(lines: pd.Series, others: pd.Series) -> pd.Series:
        xy = lambda ps: [(p["x"], p["y"]) for p in ps]
        return pd.Series([[[{"x": x, "y": y} for x, y in part] for part in split_line(xy(a), xy(b))] if len(a) else [] for a, b in zip(lines, others, strict=True)])

    return run(line, by)


def destination(lng: pd.Series, lat: pd.Series, bearing: pd.Series, meters_: pd.Series) -> pd.DataFrame:
    """lng, lat of the place on the ellipsoid at a bearing (degrees from north) and distance. For use in a pandas UDF."""
    a, b, f = ELLIPSOID_A, ELLIPSOID_B, FLATTENING
    lat, az, s = np.radians(np.asarray(lat, float)), np.radians(np.asarray(bearing, float)), np.asarray(meters_, float)
    tan_u = (1 - f) * np.tan(lat)
    cos_u = 1 / np.sqrt(1 + tan_u**2)
    sin_u = tan_u * cos_u
    along = np.arctan2(tan_u, np.cos(az))
    sin_a = cos_u * np.sin(az)
    cos2 = 1 - sin_a**2
    k = cos2 * (a * a - b * b) / (b * b)
    big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    sigma = s / (b * big)
    for _ in range(20):
        mid = np.cos(2 * along + sigma)
        fix = small * np.sin(sigma) * (mid + small / 4 * (np.cos(sigma) * (2 * mid**2 - 1) - small / 6 * mid * (4 * np.sin(sigma) ** 2 - 3) * (4 * mid**2 - 3)))
        sigma = s / (b * big) + fix
    mid = np.cos(2 * along + sigma)
    sin_s, cos_s = np.sin(sigma), np.cos(sigma)
    lat2 = np.arctan2(sin_u * cos_s + cos_u * sin_s * np.cos(az), (1 - f) * np.hypot(sin_a, sin_u * sin_s - cos_u * cos_s * np.cos(az)))
    lam = np.arctan2(sin_s * np.sin(az), cos_u * cos_s - sin_u * sin_s * np.cos(az))
    c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
    shift = lam - (1 - c) * f * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
    return pd.DataFrame({"lng": np.asarray(lng, float) + np.degrees(shift), "lat": np.degrees(lat2)})


def destinations(lng: Column, lat: Column, bearing: Column, meters_: Column) -> Column:
    return F.pandas_udf(destination, "lng double, lat double")(lng, lat, bearing, meters_)


def vincenty(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """vincenty_km over columns."""
    return F.pandas_udf(vincenty_km, "double")(lng1, lat1, lng2, lat2)


def collection(rings: Column) -> Column:
    """struct(length, area, left, bottom, right, top, x, y) of array<polygon>: sums, bounds, and the centroid weighted by
    area; null centroid when there is no area."""
    add = lambda f: F.aggregate(F.transform(rings, f), F.lit(0.0), lambda a, v: a + v)
    all_points, whole = F.flatten(rings), add(lambda r: F.abs(area(r)))
    at = lambda c: add(lambda r: F.coalesce(centroid(r)[c], F.lit(0.0)) * F.abs(area(r))) / F.nullif(whole, F.lit(0.0))
    return F.struct(add(perimeter).alias("length"), whole.alias("area"), bounds(all_points)["left"].alias("left"), bounds(all_points)["bottom"].alias("bottom"), bounds(all_points)["right"].alias("right"), bounds(all_points)["top"].alias("top"), at("x").alias("x"), at("y").alias("y"))


def haversine_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.pow(F.sin(F.radians(lng2 - lng1) / 2), F.lit(2.0)) * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return F.lit(2 * SPHERE / 1000) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def heading(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    d = F.radians(lng1 - lng2)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.degrees(F.atan2(y, x))


def mercator(lng: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lng) * SPHERE, F.log(F.tan(F.radians(lat + 90) / 2)) * SPHERE


def unmercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / SPHERE), F.degrees(2 * F.atan(F.exp(y / SPHERE))) - 90


def geodesic_area(polygon: Column) -> Column:
    """Spherical ring area in square metres of (lng, lat) vertices."""
    return _edges(polygon, lambda p, q: F.radians(q["x"] - p["x"]) * (2 + F.sin(F.radians(p["y"])) + F.sin(F.radians(q["y"])))) * (SPHERE * SPHERE / 2)


def vincenty_km(lng1: pd.Series, lat1: pd.Series, lng2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Ellipsoidal distance in km to the millimetre; NaN where the iteration does not settle. For use in a pandas UDF."""
    a, b, f = ELLIPSOID_A, ELLIPSOID_B, FLATTENING
    lng = np.radians(np.asarray(lng2, float) - np.asarray(lng1, float))
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(np.asarray(v, float)))) for v in (lat1, lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam, settled = lng.copy(), np.zeros(lng.shape, bool)
    with np.errstate(all="ignore"):
        for _ in range(20):
            sig_s = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
            sig_c = s1 * s2 + c1 * c2 * np.cos(lam)
            sigma = np.arctan2(sig_s, sig_c)
            sin_a = np.where(sig_s == 0, 0, c1 * c2 * np.sin(lam) / sig_s)
            cos2 = 1 - sin_a**2
            mid = np.where(cos2 == 0, 0, sig_c - 2 * s1 * s2 / cos2)
            c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
            new = lng + (1 - c) * f * sin_a * (sigma + c * sig_s * (mid + c * sig_c * (2 * mid**2 - 1)))
            settled |= np.abs(new - lam) < 1e-12
            lam = new
        k = cos2 * (a * a - b * b) / (b * b)
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        fix = small * sig_s * (mid + small / 4 * (sig_c * (2 * mid**2 - 1) - small / 6 * mid * (4 * sig_s**2 - 3) * (4 * mid**2 - 3)))
    return pd.Series(np.where(settled, np.round(b * big * (sigma - fix), 3) / 1000, np.nan))


def segments_intersect(a: Sequence[float], b: Sequence[float]) -> tuple[float, float] | None:
    """Point where two segments (x1, y1, x2, y2) cross, or None; parallel ones do not."""
    dx1, dy1, dx2, dy2 = a[2] - a[0], a[3] - a[1], b[2] - b[0], b[3] - b[1]
    d = dx1 * dy2 - dy1 * dx2
    if d == 0:
        return None
    t = ((b[0] - a[0]) * dy2 - (b[1] - a[1]) * dx2) / d
    u = ((b[0] - a[0]) * dy1 - (b[1] - a[1]) * dx1) / d
    return (a[0] + t * dx1, a[1] + t * dy1) if 0 <= t <= 1 and 0 <= u <= 1 else None


def point_segment_distance(x: float, y: float, s: Sequence[float]) -> float:
    dx, dy = s[2] - s[0], s[3] - s[1]
    t = 0.0 if dx == dy == 0 else min(1.0, max(0.0, ((x - s[0]) * dx + (y - s[1]) * dy) / (dx * dx + dy * dy)))
    return float(np.hypot(x - s[0] - t * dx, y - s[1] - t * dy))


def simplify(points: Sequence[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Douglas-Peucker on a line, without recursion."""
    keep, stack = {0, len(points) - 1}, [(0, len(points) - 1)]
    while stack:
        a, b = stack.pop()
        far = max(((point_segment_distance(*points[i], (*points[a], *points[b])), i) for i in range(a + 1, b)), default=(0.0, a))
        if far[0] > tolerance:
            keep.add(far[1])
            stack += [(a, far[1]), (far[1], b)]
    return [points[i] for i in sorted(keep)]


def cluster_features(rows: DataFrame, distance: float, threshold: int = 1) -> DataFrame:
    """layer, id, cluster of rows(layer, id, x, y): in id order a feature joins the first cluster whose centre (the first
    feature's place) is within distance; clusters of under threshold features fall apart (cluster null). The order
    decides, so a task holds one layer; features without a place are in no cluster."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p, cells, got, n = p.sort_values("id"), {}, [], 0
        side = distance or 1.0
        for x, y in zip(p["x"], p["y"], strict=True):
            a, b = int(np.floor(x / side)), int(np.floor(y / side))
            near = (c for i in (a - 1, a, a + 1) for j in (b - 1, b, b + 1) for c in cells.get((i, j), ()))  # centres by cell
            k = min((k for k, cx, cy in near if np.hypot(cx - x, cy - y) <= distance), default=n)
            if k == n:
                cells.setdefault((a, b), []).append((n, x, y))
                n += 1
            got.append(k)
        size = pd.Series(got).map(pd.Series(got).value_counts()).to_numpy()
        return pd.DataFrame({"layer": p["layer"], "id": p["id"], "cluster": pd.array([k if n >= threshold else None for k, n in zip(got, size, strict=True)], "Int32")})

    placed = rows.filter("x is not null and y is not null").groupBy("layer").applyInPandas(run, "layer long, id long, cluster int")
    lost = rows.filter("x is null or y is null").select(F.col("layer").cast("long").alias("layer"), F.col("id").cast("long").alias("id"), F.lit(None).cast("int").alias("cluster"))
    return placed.unionByName(lost)
