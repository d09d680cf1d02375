"""Contours of 2-D histograms: marching squares, smoothing, polygon records, scores."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import geo

# The move and the crossed edges of each corner state (1 2 4 8 mark the cells above left, above right,
# below left, below right); states 6 and 9 depend on the move that led there.
MOVES = {1: "up", 5: "up", 13: "up", 2: "right", 3: "right", 7: "right", 8: "down", 10: "down", 11: "down", 4: "left", 12: "left", 14: "left"}
EDGES = {"up": "T", "right": "R", "down": "B", "left": "L"}
SADDLES = {6: ("up", ("left", "BR"), ("right", "TL")), 9: ("right", ("up", "RT"), ("down", "LB"))}
STEPS = {"up": (0, -1), "down": (0, 1), "left": (-1, 0), "right": (1, 0)}
WEIGHTS = np.array([0.05, 0.25, 0.4, 0.25, 0.05])
RECORD = "image_key int, cluster int, level string, polygon array<struct<x: double, y: double>>"


def trace(hist: np.ndarray, threshold: float, xedges: np.ndarray, yedges: np.ndarray, interpolate: bool = True) -> list[list[tuple[float, float]]]:
    """Polygons of three or more points around the cells hist[i, j] over threshold; every row is scanned, and a trace
    ends when it returns to its start or to a visited corner in the same way."""
    nx, ny = hist.shape
    padded = np.zeros((nx + 2, ny + 2))
    padded[1:-1, 1:-1] = hist
    above = padded > threshold
    w, h = xedges[1] - xedges[0], yedges[1] - yedges[0]
    # a corner (i, j) has the cells (i-1..i, j-1..j), here one further on
    state = (above[:-1, :-1] * 1 + above[1:, :-1] * 2 + above[:-1, 1:] * 4 + above[1:, 1:] * 8).astype(int)
    covered, out = np.zeros(state.shape, bool), []

    def cross(a: float, b: float) -> float:
        return (threshold - a) / (b - a)

    def point(i: int, j: int, edge: str) -> tuple[float, float]:
        x, y = xedges[0] + i * w, yedges[0] + j * h
        tl, tr, bl, br = padded[i, j], padded[i + 1, j], padded[i, j + 1], padded[i + 1, j + 1]
        if edge == "T":
            return x + cross(tl, tr) * w - w / 2, y - h / 2
        if edge == "B":
            return x + cross(bl, br) * w - w / 2, y + h / 2
        if edge == "L":
            return x - w / 2, y + cross(tl, bl) * h - h / 2
        return x + w / 2, y + cross(tr, br) * h - h / 2

    for i0, j0 in zip(*np.nonzero((state > 0) & (state < 15)), strict=True):
        if covered[i0, j0]:
            continue
        i, j, came, polygon, seen = int(i0), int(j0), "", [], set()
        while True:
            s = int(state[i, j])
            if s in (0, 15) or (i, j, came if s in SADDLES else "") in seen:
                break
            seen.add((i, j, came if s in SADDLES else ""))
            covered[i, j] = True
            if s in SADDLES:
                by, yes, no = SADDLES[s]
                move, edges = yes if came == by else no
            else:
                move, edges = MOVES[s], EDGES[MOVES[s]]
            polygon += [point(i, j, e) for e in edges] if interpolate else [(xedges[0] + i * w, yedges[0] + j * h)]
            came, (di, dj) = move, STEPS[move]
            i, j = i + di, j + dj
            if not (0 <= i < state.shape[0] and 0 <= j < state.shape[1]):
                break
        if len(polygon) >= 3:
            out.append([(float(x), float(y)) for x, y in polygon])
    return out


def smooth(polygon: list[tuple[float, float]], steps: int = 5) -> list[tuple[float, float]]:
    """steps points a vertex from weighted straight lines through it and its two neighbours on either side."""
    v, t = np.array(polygon), np.arange(-2.0, 3.0)
    near = np.stack([np.roll(v, -k, axis=0) for k in range(-2, 3)], 1)  # vertex, offset, xy
    tm = (WEIGHTS * t).sum()
    slope_base = (WEIGHTS * (t - tm) ** 2).sum()
    mean = (WEIGHTS[None, :, None] * near).sum(1)
    slope = (WEIGHTS[None, :, None] * (t - tm)[None, :, None] * near).sum(1) / slope_base
    at = np.arange(steps) / steps
    return [tuple(map(float, p)) for p in (mean[:, None] + slope[:, None] * (at - tm)[None, :, None]).reshape(-1, 2)]


def levels(hist: np.ndarray) -> dict[str, float]:
    positive = hist[hist > 0]
    return {"min": 0.5, "p50": float(np.percentile(positive, 50)), "p95": float(np.percentile(positive, 95))} if len(positive) else {}


def contours(positions: DataFrame, nx: int, ny: int, width: int, height: int, smoothed: bool = True) -> DataFrame:
    """RECORD rows of positions(image_key, cluster, ix, iy, n), a 2-D histogram for each cluster; a task holds one
    histogram of nx x ny bins."""
    xe, ye = np.linspace(0, width, nx + 1), np.linspace(0, height, ny + 1)

    def run(p: pd.DataFrame) -> pd.DataFrame:
        hist = np.zeros((nx, ny))
        hist[p["ix"], p["iy"]] = p["n"]
        rows = []
        for name, level in levels(hist).items():
            for polygon in trace(hist, level, xe, ye):
                polygon = smooth(polygon) if smoothed else polygon
                rows.append((p["image_key"].iloc[0], p["cluster"].iloc[0], name, [{"x": x, "y": y} for x, y in polygon]))
        return pd.DataFrame(rows, columns=["image_key", "cluster", "level", "polygon"])

    return positions.groupBy("image_key", "cluster").applyInPandas(run, RECORD)


def records(contours: DataFrame, width: float, height: float, lng: Mapping, lat: Mapping) -> DataFrame:
    """contours with area_pixels, area_m2, perimeter_m, lng, lat: sizes without sign, in pixels and on the ground, and
    the centroid's place, by the image's nine points."""
    to_place = lambda x, y: (geo.lnglat(x, y, width, height, lng), geo.lnglat(x, y, width, height, lat))
    to_ground = lambda x, y: geo.meters(*to_place(x, y), F.lit(float(lng["mm"])), F.lit(float(lat["mm"])))
    c = contours.withColumns({"_ground": geo.moved(F.col("polygon"), to_ground), "_c": geo.centroid(F.col("polygon"))})
    place = to_place(F.col("_c.x"), F.col("_c.y"))
    out = c.withColumns({"area_pixels": F.abs(geo.area(F.col("polygon"))), "area_m2": F.abs(geo.area(F.col("_ground"))), "perimeter_m": geo.perimeter(F.col("_ground")), "lng": place[0], "lat": place[1]})
    return out.drop("_ground", "_c")


def score_pairs(contours: DataFrame, pixels: DataFrame, clusters: DataFrame) -> DataFrame:
    """image_key, cluster, contour_id, cluster_score, contour_score of contours(image_key, cluster, contour_id, polygon).

    cluster_score is that of clusters(image_key, cluster, mahalanobis). contour_score is the mean distance to the centre
    of the pixels(image_key, cluster, vec_id, y, x, dist2) at the rounded vertices, if all of them are pixels of the
    image; else that of the pixels nearest to the vertices (contour_scores).
    """
    vertices = contours.select("image_key", "cluster", "contour_id", F.explode("polygon").alias("p")).select("image_key", "cluster", "contour_id", F.round("p.x").cast("int").alias("x"), F.round("p.y").cast("int").alias("y"))
    at = vertices.join(pixels.select("image_key", "y", "x", "dist2"), ["image_key", "y", "x"], "left")
    exact = at.groupBy("image_key", "cluster", "contour_id").agg(F.when(F.bool_and(F.col("dist2").isNotNull()), F.avg(F.sqrt("dist2"))).alias("exact"))
    near = contour_scores(contours.select("image_key", "cluster", "contour_id", "polygon"), pixels.select("image_key", "cluster", "vec_id", "y", "x", "dist2"))
    keys = ["image_key", "cluster", "contour_id"]
    both = contours.select(*keys).join(exact, keys, "left").join(near, keys, "left").join(clusters.select("image_key", "cluster", "mahalanobis"), ["image_key", "cluster"])
    return both.select(*keys, F.col("mahalanobis").alias("cluster_score"), F.coalesce("exact", "score").alias("contour_score"))


def contour_scores(contours: DataFrame, pixels: DataFrame) -> DataFrame:
    """image_key, cluster, contour_id, score: mean centre distance of the cluster's pixels nearest to the contour's
    vertices; contours has contour_id and polygon, pixels has y, x, vec_id, dist2. The nearest pixel is sought among
    one cluster's only, in a task of its own."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"image_key": [], "cluster": [], "contour_id": [], "score": []})
        right = right.sort_values(["dist2", "vec_id"], ascending=[False, True])
        xy, d, rows = right[["x", "y"]].to_numpy(float), np.sqrt(right["dist2"].to_numpy()), []
        for cid, polygon in zip(left["contour_id"], left["polygon"], strict=True):
            v = np.array([(p["x"], p["y"]) for p in polygon])
            rows.append((*key, cid, float(np.mean([d[((xy - q) ** 2).sum(1).argmin()] for q in v]))))
        return pd.DataFrame(rows, columns=["image_key", "cluster", "contour_id", "score"])

    g = ("image_key", "cluster")
    return contours.groupBy(*g).cogroup(pixels.groupBy(*g)).applyInPandas(run, "image_key int, cluster int, contour_id long, score double")
