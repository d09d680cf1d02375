"""K-means, distances, anomalies and connected components."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the stop rule and of the seeding.
MOVED, HARDLY, ROUNDS, TRIALS, REFINE = 1e-2, 1e-3, 10, 10, 1000


def distance2(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, x: s + x)


def nearest(spectrum: Column, centers: Sequence[Sequence[float]]) -> Column:
    """struct(dist2, cluster) of the nearest centre, the lowest of equals; centres are a fixed small matrix."""
    return F.array_min(F.array(*[F.struct(distance2(spectrum, F.array(*map(F.lit, map(float, c)))).alias("dist2"), F.lit(i).alias("cluster")) for i, c in enumerate(centers)]))


def assign(pixels: DataFrame, centers: Sequence[Sequence[float]], bands: int) -> DataFrame:
    p = pixels.withColumn("spectrum", F.slice("spectrum", 1, bands))
    n = F.expr("near")
    return p.withColumn("near", nearest(F.col("spectrum"), centers)).select(*p.columns, n["cluster"].alias("cluster"), n["dist2"].alias("dist2"))


def update(assigned: DataFrame) -> DataFrame:
    """cluster, n, band, center: means of the assigned pixels."""
    t = assigned.select("cluster", F.posexplode("spectrum").alias("b", "v"))
    return t.groupBy("cluster", (F.col("b") + 1).alias("band")).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("center"))


def quality(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sqrt(F.sum("dist2")).alias("quality"))


def mahalanobis2(center: Column, eigenvalues: Column) -> Column:
    return F.aggregate(F.zip_with(center, eigenvalues, lambda x, e: x * x / e), F.lit(0.0), lambda a, v: a + v)


def nearest_center(data: np.ndarray, centers: np.ndarray, block: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centre, the lowest of equals, in blocks of rows."""
    labels, least = np.empty(len(data), int), np.empty(len(data))
    for i in range(0, len(data), block):
        d = ((data[i : i + block, None] - centers[None]) ** 2).sum(2)
        labels[i : i + block] = d.argmin(1)
        least[i : i + block] = d.min(1)
    return labels, least


def lloyd(data: np.ndarray, centers: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centres and labels; empty clusters keep their centre; ends when all moves are under MOVED and over half under
    HARDLY, or after the rounds."""
    for _ in range(rounds):
        labels = nearest_center(data, centers)[0]
        new = np.stack([data[labels == k].mean(0) if (labels == k).any() else centers[k] for k in range(len(centers))])
        moved = np.abs(new - centers)
        centers = new
        if moved.max() < MOVED and (moved < HARDLY).mean() > 0.5:
            break
    return centers, nearest_center(data, centers)[0]


def cluster_quality(data: np.ndarray, centers: np.ndarray) -> float:
    return float(np.sqrt(nearest_center(data, centers)[1].sum()))


def kmeans(data: np.ndarray, clusters: int, seed: int, trials: int = TRIALS, refine: int = REFINE) -> tuple[np.ndarray, np.ndarray]:
    """The best of several seedings refined on a part of the data, then run on all of it."""
    rng, best = np.random.default_rng(seed), None
    clusters = min(clusters, len(data))
    for _ in range(trials):
        part = data[rng.choice(len(data), min(refine, len(data)), replace=False)]
        centers, _ = lloyd(part, data[rng.choice(len(data), clusters, replace=False)])
        q = cluster_quality(part, centers)
        if best is None or q < best[0]:
            best = (q, centers)
    return lloyd(data, best[1])


def kmeans_images(pixels: DataFrame, clusters: int, bands: int, seed: int = 7) -> DataFrame:
    """image_key, vec_id, cluster, dist2 by one k-means for each image (a task holds one image)."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("vec_id")
        data = np.stack(p["spectrum"].to_list())[:, :bands]
        centers, labels = kmeans(data, clusters, seed)
        return pd.DataFrame({"image_key": p["image_key"], "vec_id": p["vec_id"], "cluster": labels, "dist2": ((data - centers[labels]) ** 2).sum(1)})

    return pixels.groupBy("image_key").applyInPandas(run, "image_key int, vec_id long, cluster int, dist2 double")


def anomalies(scored: DataFrame, fraction: float = 0.01) -> DataFrame:
    """The first round(fraction * n) pixels of each image by centre score, then distance to the centre, both falling."""
    w = Window.partitionBy("image_key")
    order = w.orderBy(F.desc("mahalanobis"), F.desc("dist2"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(w)).filter(F.col("rank") <= F.round(F.col("n") * fraction)).drop("n")


def anomalous_labels(top: DataFrame) -> DataFrame:
    """image_key, cluster: the clusters that have one of the top pixels at least."""
    return top.select("image_key", "cluster").distinct()


def anomalous_clusters(assigned: DataFrame, top: DataFrame) -> DataFrame:
    """image_key, cluster, n, center_y, center_x of the clusters with a top pixel, over all pixels of theirs in
    assigned(image_key, vec_id, y, x, cluster, dist2): the centre pixel is the nearest to the centre, the lowest vec_id
    of equals."""
    a = assigned.join(anomalous_labels(top), ["image_key", "cluster"], "left_semi")
    near = F.min_by(F.struct("y", "x"), F.struct("dist2", "vec_id"))
    return a.groupBy("image_key", "cluster").agg(F.count(F.lit(1)).alias("n"), near.alias("c")).select("image_key", "cluster", "n", F.col("c.y").alias("center_y"), F.col("c.x").alias("center_x"))


def center_vectors(clusters: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """clusters with center, the vector of their centre."""
    table = F.array(*[F.array(*map(F.lit, map(float, c))) for c in centers])
    return clusters.withColumn("center", F.get(table, F.col("cluster")))


def label_regions(grid: np.ndarray) -> np.ndarray:
    """8-neighbour components of the true cells, labels dense from 1 in row order."""
    out, label = np.zeros(grid.shape, np.int32), 0
    for y, x in zip(*np.nonzero(grid), strict=True):
        if out[y, x]:
            continue
        label += 1
        stack = [(y, x)]
        out[y, x] = label
        while stack:
            a, b = stack.pop()
            for p in range(max(0, a - 1), min(grid.shape[0], a + 2)):
                for q in range(max(0, b - 1), min(grid.shape[1], b + 2)):
                    if grid[p, q] and not out[p, q]:
                        out[p, q] = label
                        stack.append((p, q))
    return out


def regions(cells: DataFrame, lower: int = 1, upper: int = 1 << 30) -> DataFrame:
    """image_key, cluster, y, x, region, size of the connected cells(image_key, cluster, y, x), by size."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        grid = np.zeros((p["y"].max() + 1, p["x"].max() + 1), bool)
        grid[p["y"], p["x"]] = True
        p = p.assign(region=label_regions(grid)[p["y"], p["x"]])
        p["size"] = p.groupby("region")["region"].transform("size")
        return p[(p["size"] >= lower) & (p["size"] <= upper)]

    return cells.select("image_key", "cluster", "y", "x").groupBy("image_key", "cluster").applyInPandas(run, "image_key int, cluster int, y int, x int, region int, size int")
