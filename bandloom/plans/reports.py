"""Catalog, image and run reports."""

from __future__ import annotations

from html import escape

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def catalog_filter(catalog: DataFrame, radiance: tuple[float, float], millis: tuple[int, int], lng: float, lat: float, radius: float) -> DataFrame:
    """Rows of catalog(directory, acquisition_start, radiance, corners) within the bounds and, unless radius is 0, whose
    mean corner is nearer than radius to a point."""
    mean = lambda i: F.aggregate("corners", F.lit(0.0), lambda a, c: a + c[i]) / F.size("corners")
    near = F.lit(radius == 0) | (F.sqrt(F.pow(mean(0) - lng, F.lit(2.0)) + F.pow(mean(1) - lat, F.lit(2.0))) < radius)
    return catalog.filter(F.col("radiance").between(*radiance) & F.col("acquisition_start").between(*millis) & near)


def catalog_bounds(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.least(F.min("radiance"), F.lit(0.0)).alias("min_radiance"), F.max("radiance").alias("max_radiance"), F.min("acquisition_start").alias("min_time"), F.max("acquisition_start").alias("max_time"))


def catalog_json(catalog: DataFrame) -> DataFrame:
    """The catalog as one JSON object, for catalogs that a page can show; its two field names are fixed values."""
    row = F.struct(*catalog.columns)
    return catalog.agg(F.to_json(F.struct(F.array_sort(F.collect_list(row)).alias("hyperion"), F.array().cast("array<string>").alias("ali"))).alias("json"))


def last_of(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The value of each key that comes last in an order."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def report_rows(images: DataFrame, clusters: DataFrame, statistics: DataFrame) -> DataFrame:
    """Images with their clusters' polygons and the run's one row of statistics; an image without clusters is dropped."""
    grouped = clusters.groupBy("image_key").agg(F.array_sort(F.collect_list(F.struct("cluster", "score", "style"))).alias("clusters"))
    return images.join(grouped, "image_key").join(F.broadcast(statistics.limit(1)))


def top_contours(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.orderBy(F.desc("cluster_score"), F.desc("contour_score"), "id").limit(n)


def run_report(summary: DataFrame, contours: DataFrame, n: int = 10) -> DataFrame:
    """rank, id, cluster_score, contour_score, images, average_pixels, outlier: the first contours of a run, each with
    the run's one row of summary; a run without contours has no rows."""
    top = top_contours(contours, n)
    rank = F.row_number().over(Window.orderBy(F.desc("cluster_score"), F.desc("contour_score"), "id"))  # of n rows
    return top.withColumn("rank", rank).join(F.broadcast(summary.limit(1)))


def image_contours(contours: DataFrame) -> DataFrame:
    """image_key, contours: each image's table of its contours(image_key, id, area_m2, lng, lat, cluster_score,
    contour_score), best first, as a page shows it."""
    row = F.struct((-F.col("cluster_score")).alias("o1"), (-F.col("contour_score")).alias("o2"), "id", F.round("area_m2", 3).alias("area_m2"), F.round("lng", 5).alias("lng"), F.round("lat", 5).alias("lat"))
    return contours.groupBy("image_key").agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: F.concat_ws("|", r["id"], r["area_m2"], r["lng"], r["lat"])).alias("contours"))


def spectra_pages(spectra: DataFrame) -> DataFrame:
    """page, value, images of spectra(image_key, value): one page for equal contents, named by their SHA-224."""
    named = spectra.withColumn("page", F.sha2(F.col("value").cast("binary"), 224))
    return named.groupBy("page").agg(F.first("value").alias("value"), F.count_distinct("image_key").alias("images"))


def svg_overlay(width: int, height: int, png_base64: Column, paths: Column) -> Column:
    """An image with closed polygons over it, as one SVG document; paths is an array of svg()."""
    head = F.concat(F.lit(f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><image width="{width}" height="{height}" href="data:image/png;base64,'), png_base64, F.lit('"/>'))
    return F.concat(head, F.array_join(paths, ""), F.lit("</svg>"))


def svg_curve(points: Column, width: float, height: float) -> Column:
    """A path through array<struct<x, y>>, stretched over width and height."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    at = lambda v, all_, size: F.coalesce((v - F.array_min(all_)) / F.nullif(F.array_max(all_) - F.array_min(all_), F.lit(0.0)), F.lit(0.0)) * size
    pts = F.transform(points, lambda p: F.concat_ws(",", F.round(at(p["x"], xs, width), 2), F.round(F.lit(height) - at(p["y"], ys, height), 2)))
    return F.concat(F.lit('<path fill="none" d="M'), F.array_join(pts, " L"), F.lit('"/>'))


def svg(width: int, height: int, polygon: Column, color: Column) -> Column:
    """One closed polygon as an SVG path."""
    pts = F.transform(polygon, lambda p: F.concat_ws(",", F.round(p["x"], 2), F.round(p["y"], 2)))
    return F.concat(F.lit('<path fill="none" stroke="'), color, F.lit('" d="M'), F.array_join(pts, " L"), F.lit(' Z"/>'))


def svg_document(width: int, height: int, png_base64: str, paths: list[str]) -> str:
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><image width="{width}" height="{height}" href="data:image/png;base64,{png_base64}"/>' + "".join(paths) + "</svg>"


def html_table(title: str, columns: list[str], rows: list[tuple]) -> str:
    """A small page with one table; rows are a report's, already cut to what a page shows."""
    head = "".join(f"<th>{escape(c)}</th>" for c in columns)
    body = "".join("<tr>" + "".join(f"<td>{escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
    return f"<html><head><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1><table><tr>{head}</tr>{body}</table></body></html>"
