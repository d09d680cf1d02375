"""Covariance, principal components, projection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of Gram matrices that a task holds before it hands them on.
HELD = 4_000_000
PARTIAL = "key {kind}, n long, s array<double>, g array<double>"


def partials(pixels: DataFrame, key: str, kind: str = "int") -> DataFrame:
    """Per task and key: pixel count, sum and Gram matrix of the spectra; the partial aggregate of a covariance."""

    def table(acc: dict) -> pd.DataFrame:
        return pd.DataFrame([(k, n, s, g.ravel()) for k, (n, s, g) in acc.items()], columns=["key", "n", "s", "g"])

    def run(batches: Iterator[pd.DataFrame]):
        acc: dict = {}
        for b in batches:
            for k, rows in b.groupby("key"):
                a = np.stack(rows["spectrum"].to_list())
                n, s, g = acc.get(k, (0, 0.0, 0.0))
                acc[k] = (n + len(a), s + a.sum(0), g + a.T @ a)
            if len(acc) * a.shape[1] ** 2 > HELD:  # many keys in a task: partials of one key may be several rows
                yield table(acc)
                acc = {}
        yield table(acc)

    return pixels.select(F.col(key).alias("key"), "spectrum").mapInPandas(run, PARTIAL.format(kind=kind))


def covariance(pixels: DataFrame, key: str, kind: str = "int") -> DataFrame:
    """key, band_a, band_b, cov (sample covariance; null for one pixel) from the partials, added up element by element."""
    # sums and Gram matrix in one array, so that the pixels are read once: s first, then g row by row
    p = partials(pixels, key, kind).select("key", "n", F.size("s").alias("b"), F.posexplode(F.concat("s", "g")).alias("i", "v"))
    total = p.groupBy("key", "i").agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.max("b").alias("b"))
    one = total.groupBy("key").agg(F.max("n").alias("n"), F.max("b").alias("b"), F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda e: e["v"]).alias("m"))
    band = F.explode(F.sequence(F.lit(0), F.col("b") * F.col("b") - 1))
    pair = one.select("key", "n", "b", "m", band.alias("k")).withColumns({"ia": F.floor(F.col("k") / F.col("b")).cast("int"), "ib": (F.col("k") % F.col("b")).cast("int")})
    less = F.nullif(F.col("n") - 1, F.lit(0))
    cov = F.get("m", F.col("b") + F.col("k")) / less - F.get("m", "ia") * F.get("m", "ib") / (F.col("n") * less)
    return pair.select("key", (F.col("ia") + 1).alias("band_a"), (F.col("ib") + 1).alias("band_b"), cov.alias("cov"))


def aligned(images: DataFrame) -> DataFrame:
    """region_key, bands: the band names that all images(region_key, image_key, band_names) of a region have."""
    b = images.select("region_key", "image_key", F.explode(F.array_distinct("band_names")).alias("band"))
    of = images.groupBy("region_key").agg(F.count_distinct("image_key").alias("images"))
    return b.groupBy("region_key", "band").agg(F.count_distinct("image_key").alias("n")).join(of, "region_key").filter("n = images").groupBy("region_key").agg(F.array_sort(F.collect_list("band")).alias("bands"))


def components(matrix: np.ndarray, noise: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, descending, and eigenvectors as rows, their largest loading positive; with a noise covariance those
    of inv(matrix) @ noise, ascending."""
    if noise is None:
        values, vectors = np.linalg.eigh(matrix)
        order = np.argsort(-values, kind="stable")
    else:
        values, vectors = (x.real for x in np.linalg.eig(np.linalg.solve(matrix, noise)))
        order = np.argsort(values, kind="stable")
    rows = vectors.T[order]
    sign = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(1)])
    return values[order], rows * np.where(sign == 0, 1, sign)[:, None]


def pca(cov: DataFrame, kind: str = "int") -> DataFrame:
    """key, component (from 1), eigenvalue, loadings of covariance rows; a task holds one bands x bands matrix."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        n = int(p["band_a"].max())
        m = np.zeros((n, n))
        m[p["band_a"] - 1, p["band_b"] - 1] = p["cov"]
        values, rows = components(m)
        return pd.DataFrame({"key": p["key"].iloc[0], "component": np.arange(1, n + 1), "eigenvalue": values, "loadings": list(rows)})

    return cov.filter("cov is not null").groupBy("key").applyInPandas(run, f"key {kind}, component int, eigenvalue double, loadings array<double>")


def noise_pca(cov: DataFrame, noise: DataFrame, kind: str = "int") -> DataFrame:
    """As pca, of inv(cov) @ noise by rising eigenvalue: the components with least noise first. Keys without noise rows
    vanish; a task holds two bands x bands matrices."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        n = int(p["band_a"].max())
        m = np.zeros((2, n, n))
        m[p["is_noise"].astype(int), p["band_a"] - 1, p["band_b"] - 1] = p["cov"]
        values, rows = components(m[0], m[1])
        return pd.DataFrame({"key": p["key"].iloc[0], "component": np.arange(1, n + 1), "eigenvalue": values, "loadings": list(rows)})

    noise = noise.filter("cov is not null")
    keys = noise.select("key").distinct()
    both = cov.filter("cov is not null").join(keys, "key", "left_semi").withColumn("is_noise", F.lit(False)).unionByName(noise.withColumn("is_noise", F.lit(True)))
    return both.groupBy("key").applyInPandas(run, f"key {kind}, component int, eigenvalue double, loadings array<double>")


def noise_covariance(differences: DataFrame) -> DataFrame:
    """key, band_a, band_b, cov of differences(image_key, y, x, band, diff), an image's noise signal."""
    s = differences.groupBy("image_key", "y", "x").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "diff"))), lambda e: e["diff"]).alias("spectrum"))
    return covariance(s, "image_key")


def project_models(pixels: DataFrame, means: DataFrame, model: DataFrame, keep: int = 5, region: str = "image_key") -> DataFrame:
    """pixels with component and value: their spectra less the image's mean(image_key, mean), on the first components of
    the model(key, component, loadings) of their region. Pixels of a region without a model vanish. A model has a few
    rows of one array a region, so rows of a frequent region meet it by a join that can be split."""
    m = model.filter(F.col("component") <= keep).select(F.col("key").alias("_key"), "component", "loadings")
    centred = F.zip_with("spectrum", "mean", lambda v, a: v - a)
    value = F.aggregate(F.zip_with(centred, F.col("loadings"), lambda v, w: v * w), F.lit(0.0), lambda a, x: a + x)
    p = pixels.join(means, "image_key").join(m, F.expr(f"{region} = _key"))
    return p.withColumn("value", value).drop("_key", "loadings", "mean", "spectrum")


def explained(model: DataFrame, first: int = 5) -> DataFrame:
    """key, component, ratio of the first components."""
    total = F.sum("eigenvalue").over(Window.partitionBy("key"))
    return model.withColumn("ratio", F.col("eigenvalue") / total).filter(F.col("component") <= first).select("key", "component", "ratio")


def project(spectrum: Column, mean: Column, basis: Sequence[Sequence[float]]) -> Column:
    """The components of a spectrum less the image's mean, as an array; the basis is a fixed small matrix."""
    centred = F.zip_with(spectrum, mean, lambda v, m: v - m)
    dot = lambda row: F.aggregate(F.zip_with(centred, F.array(*map(F.lit, row)), lambda v, w: v * w), F.lit(0.0), lambda a, x: a + x)
    return F.array(*map(dot, basis))


def means(tall: DataFrame) -> DataFrame:
    """image_key and the array of band means of tall(image_key, band, value)."""
    m = tall.groupBy("image_key", "band").agg(F.avg("value").alias("m"))
    return m.groupBy("image_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "m"))), lambda e: e["m"]).alias("mean"))


def rogue_bands(loadings: DataFrame, thresholds: Sequence[float] = (0.1, 0.2)) -> DataFrame:
    """loadings(key, component, band, loading) whose leaving out changes the component's population sigma by more than
    the lowest threshold, as a share; level counts the thresholds passed."""
    w = Window.partitionBy("key", "component")
    n, s, q = F.count(F.lit(1)).over(w), F.sum("loading").over(w), F.sum(F.pow("loading", F.lit(2.0))).over(w)
    v = F.col("loading")
    sd = F.sqrt(F.greatest(q / n - F.pow(s / n, F.lit(2.0)), F.lit(0.0)))
    without = F.sqrt(F.greatest((q - v * v) / (n - 1) - F.pow((s - v) / (n - 1), F.lit(2.0)), F.lit(0.0)))
    d = loadings.withColumn("change", F.abs(sd - without) / F.nullif(sd, F.lit(0.0)))
    level = sum((F.when(F.col("change") > t, 1).otherwise(0) for t in thresholds), F.lit(0))
    return d.withColumn("level", level).filter("level > 0")
