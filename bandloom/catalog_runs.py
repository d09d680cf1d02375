"""More registered queries: runs and reports, image models, files and formats, geometry, streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .catalog import GRAY, HIST, LL, MEANS, NINE_LAT, NINE_LNG, POLY, PX, SCORED, TALL, SQL, _taylor, cluster_positions, located, model, polygons, query, r6, rounded, scored, shared_folder, ten_centers
from .functions import scalar
from .operators import cluster, contour, geo, linalg, raster, stats
from .plans import cql, reports
from .sources import codecs, features, kv, markup, sequence
from .sources.tables import pixels, read, stream, tall
from .streaming import ingest

# ---- runs

PER_IMAGE = f"""{GRAY}, m AS (SELECT image_key, avg(gray) AS mean, stddev_pop(gray) AS sigma FROM k GROUP BY 1),
    st AS (SELECT image_key, first(n) AS num_pixels, first(mean) AS mean, first(sigma) AS sigma, sum(CASE WHEN gray > mean + sigma THEN 1 ELSE 0 END) / first(n) AS plus_one_sigma,
      sum(CASE WHEN gray < mean - sigma THEN 1 ELSE 0 END) / first(n) AS minus_one_sigma FROM k JOIN m USING (image_key) GROUP BY image_key)"""
STATISTICS = ("num_pixels", "mean", "sigma", "plus_one_sigma", "minus_one_sigma")


@query(f"WITH {PER_IMAGE} SELECT count(*) AS images, {', '.join(f'round(avg({c}), 6) AS {c}' for c in STATISTICS)} FROM st")
def run_means(spark, d):
    return rounded(stats.run_means(stats.gray_band_stats(pixels(spark, d)), STATISTICS))


PAIRS = f"""src AS (SELECT image_key AS k, gray AS v FROM k), {HIST.format(b=100)}, pairs AS (SELECT p.k AS a, q.k AS b, corr(p.n, q.n) AS correlation,
    0.5 * sum(CASE WHEN p.n + q.n > 0 THEN pow(p.n - q.n, 2) / (p.n + q.n) ELSE 0.0 END) AS chi2 FROM h p JOIN h q ON p.bin = q.bin AND p.k <> q.k GROUP BY 1, 2)"""


def image_histograms(spark, d):
    p = pixels(spark, d).select("image_key", stats.gray(F.col("spectrum")).alias("gray"))
    return stats.histogram(stats.trimmed(p), "image_key", "gray")


SUMMARY = f"""{PER_IMAGE}, {PAIRS}, su AS (SELECT count(*) AS images, avg(num_pixels) AS average_pixels,
    (SELECT a FROM pairs GROUP BY a HAVING avg(correlation / chi2) > 0 ORDER BY avg(correlation / chi2) DESC, a LIMIT 1) AS outlier FROM st)"""


def summary(spark, d):
    return stats.run_summary(stats.gray_band_stats(pixels(spark, d)), image_histograms(spark, d))


@query(f"WITH {SUMMARY} SELECT images, round(average_pixels, 6) AS average_pixels, outlier FROM su")
def run_summary(spark, d):
    return rounded(summary(spark, d))


TOP = "SELECT CAST(event_id AS VARCHAR) AS id, value AS cluster_score, CAST(user_id AS DOUBLE) AS contour_score, row_number() OVER (ORDER BY value DESC NULLS LAST, user_id DESC, CAST(event_id AS VARCHAR)) AS rank FROM events QUALIFY rank <= 10"


@query(f"WITH {SUMMARY}, top AS ({TOP}) SELECT CAST(rank AS INTEGER) AS rank, id, cluster_score, contour_score, images, round(average_pixels, 6) AS average_pixels, outlier FROM top, su")
def run_report(spark, d):
    e = read(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.col("value").alias("cluster_score"), F.col("user_id").cast("double").alias("contour_score"))
    return reports.run_report(summary(spark, d), e).withColumn("average_pixels", r6("average_pixels"))


TOPPED = f"""{SCORED}, o AS (SELECT *, row_number() OVER (PARTITION BY image_key ORDER BY mahalanobis DESC, dist2 DESC, vec_id) AS rank, count(*) OVER (PARTITION BY image_key) AS total FROM sc),
    lab AS (SELECT DISTINCT image_key, cluster FROM o WHERE rank <= round(total * 0.1))"""


def top_pixels(spark, d):
    return cluster.anomalies(scored(spark, d), 0.1)


@query(f"WITH {TOPPED} SELECT * FROM lab")
def anomalous_labels(spark, d):
    return cluster.anomalous_labels(top_pixels(spark, d))


@query(f"""WITH {TOPPED} SELECT image_key, a.cluster, count(*) AS n, arg_min(vec_id // 25, dist2) AS center_y, arg_min(vec_id % 25, dist2) AS center_x, {', '.join(f'round(first(c[{i}]), 6) AS c{i}' for i in range(1, 5))}
    FROM a JOIN lab USING (image_key, cluster) GROUP BY 1, 2""")
def anomalous_clusters(spark, d):
    found = cluster.anomalous_clusters(scored(spark, d), top_pixels(spark, d))
    found = cluster.center_vectors(found, ten_centers(spark, d))
    return found.select("image_key", "cluster", "n", F.col("center_y").cast("long").alias("center_y"), F.col("center_x").cast("long").alias("center_x"), *[r6(F.get("center", F.lit(i))).alias(f"c{i + 1}") for i in range(4)])


# ---- models

MODEL = "mo AS (SELECT image_key, component, band, v AS loading FROM t JOIN (SELECT vec_id, row_number() OVER (PARTITION BY image_key ORDER BY vec_id) AS component FROM px) USING (vec_id) WHERE component <= 3)"


def stand_in_model(spark, d):
    """A model table: the spectra of the three lowest pixels of each image stand as loadings."""
    first = F.slice(F.array_sort(F.collect_list(F.struct("vec_id", "spectrum"))), 1, 3)
    m = pixels(spark, d).groupBy(F.col("image_key").alias("key")).agg(first.alias("m")).select("key", F.posexplode("m").alias("i", "e"))
    return m.select("key", (F.col("i") + 1).alias("component"), F.col("e.spectrum").alias("loadings"))


@query(f"WITH {TALL}, {MEANS}, {MODEL} SELECT t.vec_id, CAST(component AS INTEGER) AS component, round(sum((t.v - m) * loading), 6) AS value FROM t JOIN m USING (image_key, band) JOIN mo USING (image_key, band) GROUP BY 1, 2")
def project_models(spark, d):
    p = pixels(spark, d)
    return rounded(linalg.project_models(p, linalg.means(tall(p)), stand_in_model(spark, d)).select("vec_id", "component", "value"))


@query(f"WITH {TALL}, {MEANS}, {MODEL} SELECT t.vec_id, CAST(component AS INTEGER) AS component, round(sum((t.v - m) * loading), 6) AS value FROM t JOIN m USING (image_key, band) JOIN mo USING (image_key, band) WHERE component <= 2 GROUP BY 1, 2")
def first_components(spark, d):
    p = pixels(spark, d)
    return rounded(linalg.project_models(p, linalg.means(tall(p)), stand_in_model(spark, d), keep=2).select("vec_id", "component", "value"))


@query()
def noise_adjusted_pca(spark, d):
    p = pixels(spark, d).withColumn("image_key", F.lit(0))
    noise = linalg.noise_covariance(raster.noise_difference(p, skip=2))
    return rounded(linalg.noise_pca(linalg.covariance(p, "image_key"), noise).select("key", "component", "eigenvalue"))


@query()
def pca_loadings(spark, d):
    m = model(spark, d).filter("component <= 5").select("key", "component", F.posexplode("loadings").alias("i", "loading"))
    return m.select("key", "component", (F.col("i") + 1).alias("band"), r6("loading").alias("loading"))


@query("SELECT key, arg_max(value, event_id) AS value FROM (SELECT event_type AS key, event_id, props AS value FROM events) GROUP BY key")
def model_last_wins(spark, d):
    e = read(spark, d, "events").select(F.col("event_type").alias("key"), "event_id", F.col("props").alias("value"))
    return kv.last_by(e, "key", "event_id").select("key", "value")


# ---- images

SOLAR = "(2.5e-28 / (exp(0.0143878 / ((400 + 10 * band) * 1e-9) / 5778) - 1) / pow((400 + 10 * band) * 1e-9, 5))"


def band_tables(spark):
    b = spark.range(1, 65, 1, 1).select(F.col("id").cast("int").alias("band"))
    return b.filter("band % 3 <> 0").select("band", F.lit(0.025).alias("multiplier")), b.filter("band % 5 <> 0").select("band", (400 + 10 * F.col("band")).cast("double").alias("nm"))


@query(f"WITH {TALL} SELECT vec_id, CAST(band AS INTEGER) AS band, round(ln(abs(v) * 0.025 / {SOLAR} + 1e-6), 6) AS value FROM t WHERE band % 3 <> 0 AND band % 5 <> 0")
def calibrated_bands(spark, d):
    t = tall(pixels(spark, d)).withColumn("value", F.abs("value"))
    return rounded(raster.calibrated(t, *band_tables(spark)).select("vec_id", "band", "value"))


@query(f"WITH {TALL} SELECT vec_id, CAST(band AS INTEGER) AS band, round(v * 0.025 / {SOLAR} * 1e6, 4) + 0.0 AS value FROM t WHERE band % 3 <> 0 AND band % 5 <> 0")
def normalize_without_log(spark, d):
    t = raster.calibrated(tall(pixels(spark, d)), *band_tables(spark), log=False)
    return t.select("vec_id", "band", (F.round(F.col("value") * 1e6, 4) + 0.0).alias("value"))


@query("SELECT s_suppkey, array_to_string(list_sort(list_distinct(list_filter(['B' || (s_suppkey % 3), 'B1', 'B2', 'B' || (s_suppkey % 2 + 4)], lambda b: b IN ('B0', 'B1', 'B4') AND b IN ('B1', 'B2', 'B4', 'B5')))), ',') AS bands FROM supplier")
def band_selection(spark, d):
    k = F.col("s_suppkey")
    names = F.array(F.concat(F.lit("B"), k % 3), F.lit("B1"), F.lit("B2"), F.concat(F.lit("B"), k % 2 + 4))
    wavelengths = F.create_map(*[x for i in (1, 2, 4, 5) for x in (F.lit(f"B{i}"), F.lit(400.0 + i))])
    return read(spark, d, "supplier").select("s_suppkey", F.array_join(raster.good_bands(names, wavelengths, ("B0", "B1", "B4")), ",").alias("bands"))


@query(f"WITH {PX}, e AS (SELECT image_key, min(s[1]) AS lo, max(s[1]) AS hi FROM px GROUP BY 1) SELECT vec_id, CAST(coalesce(trunc(255 * ((s[1] - lo) / nullif(hi - lo, 0))), 0) AS INTEGER) AS value FROM px JOIN e USING (image_key)")
def raster_bytes(spark, d):
    p = pixels(spark, d).select("image_key", "vec_id", F.element_at("spectrum", 1).alias("value"))
    return raster.scaled_bytes(p, "value").select("vec_id", "value")


@query(f"WITH {TALL} SELECT image_key, y, x, 400 + 10 * CAST(band AS INTEGER) AS wavelength, round(v, 6) AS value FROM t WHERE x = image_key % 25 AND y % 3 = 1")
def spectrum_curve(spark, d):
    p = pixels(spark, d)
    points = p.filter("x = image_key % 25 and y % 3 = 1").select("image_key", "y", "x")
    return rounded(raster.spectrum_curve(raster.spectrum_at(p, points), 400 + 10 * F.col("band")))


@query(f"WITH {PX} SELECT vec_id, round(list_sum(s), 6) AS total FROM px WHERE (y, x) IN (SELECT (CAST(e.event_id % 20 AS INTEGER), CAST(e.user_id % 25 AS INTEGER)) FROM events e)")
def spectrum_lookup(spark, d):
    p = pixels(spark, d)
    points = read(spark, d, "events").select((F.col("event_id") % 20).cast("int").alias("y"), (F.col("user_id") % 25).cast("int").alias("x")).distinct()
    points = points.join(p.select("image_key", "y", "x"), ["y", "x"])
    return raster.spectrum_at(p, points).select("vec_id", r6(F.aggregate("spectrum", F.lit(0.0), lambda a, v: a + v)).alias("total"))


@query(f"""WITH {PX}, e AS (SELECT image_key, vec_id, s[1] AS m, exp(s[10]) AS r, exp(s[20]) AS g, exp(s[30]) AS b FROM px),
    m AS (SELECT image_key, least(min(r), min(g), min(b)) AS lo, greatest(max(r), max(g), max(b)) AS hi FROM e GROUP BY 1)
    SELECT image_key, CAST(count(*) AS INTEGER) AS pixels, CAST(sum(floor(255 * (b - lo) / (hi - lo))) AS BIGINT) AS first, CAST(sum(floor(255 * (r - lo) / (hi - lo))) AS BIGINT) AS third, CAST(255 * sum(CASE WHEN m > 0 THEN 1 ELSE 0 END) AS BIGINT) AS alpha FROM e JOIN m USING (image_key) GROUP BY 1""")
def rgba_png(spark, d):
    """Sums of the channels of each image's overlay after encoding as RGBA PNG and decoding; null where no pixel has the band."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("vec_id")
        rgb = p[["r", "g", "b"]].to_numpy(float)
        a = codecs.rgba_decode(codecs.rgba_image(np.nan_to_num(rgb)[None], p["opaque"].to_numpy()[None])).astype(int)
        first, third = (None if np.isnan(rgb[:, 2 - k]).all() else a[:, :, k].sum() for k in (0, 2))
        return pd.DataFrame({"image_key": [p["image_key"].iloc[0]], "pixels": a.shape[1], "first": first, "third": third, "alpha": a[:, :, 3].sum()})

    p = pixels(spark, d).withColumn("opaque", F.coalesce(F.try_element_at("spectrum", F.lit(1)) > 0, F.lit(False)))
    rgb = raster.rgb_stretch(p, (10, 20, 30), ["opaque"])
    return rgb.groupBy("image_key").applyInPandas(run, "image_key int, pixels int, first long, third long, alpha long")


CORNERS = """cm AS (SELECT image_key, y, x FROM px WHERE s[1] > 0.1), ce AS (SELECT *, min(x) OVER w AS x0, max(x) OVER w AS x1, min(y) OVER w AS y0, max(y) OVER w AS y1 FROM cm WINDOW w AS (PARTITION BY image_key)),
    cf AS (SELECT image_key, min(x) AS left_x, floor(avg(CASE WHEN x = x0 THEN y END) + 0.5) AS left_y, floor(avg(CASE WHEN y = y0 THEN x END) + 0.5) AS top_x, min(y) AS top_y,
      max(x) AS right_x, floor(avg(CASE WHEN x = x1 THEN y END) + 0.5) AS right_y, floor(avg(CASE WHEN y = y1 THEN x END) + 0.5) AS bottom_x, max(y) AS bottom_y FROM ce GROUP BY image_key)"""
SIDES = ", ".join(f"(SELECT round(CAST({_taylor(p)} AS DOUBLE), 6) FROM (SELECT {s}_x AS x, {s}_y AS y)) AS {s}_{n}" for s in ("left", "top", "right", "bottom") for n, p in (("lng", NINE_LNG), ("lat", NINE_LAT)))


@query(f"WITH {PX}, {CORNERS} SELECT image_key, {SIDES} FROM cf")
def corner_lnglat(spark, d):
    c = raster.corners(pixels(spark, d).withColumn("in_mask", F.element_at("spectrum", 1) > 0.1)).filter("left_x >= 0")
    return rounded(geo.corner_lnglat(c, 25.0, 20.0, NINE_LNG, NINE_LAT))


def image_text(spark, d):
    o = read(spark, d, "orders")
    day = F.concat_ws(" ", F.year("o_orderdate"), F.lpad(F.dayofyear("o_orderdate").cast("string"), 3, "0"))
    lines = ["GROUP = L1T", "GROUP = L1_METADATA_FILE", "GROUP = PRODUCT_METADATA", F.concat(F.lit('START_TIME = "'), day, F.lit(' 01:02:03"')), F.concat(F.lit('END_TIME = "'), day, F.lit(' 02:02:03"')), "END_GROUP = PRODUCT_METADATA", "GROUP = PRODUCT_PARAMETERS", F.concat(F.lit("SUN_AZIMUTH = "), (F.col("o_orderkey") % 360).cast("string"), F.lit(".25")), "SUN_ELEVATION = 40.5", F.concat(F.lit("SENSOR_LOOK_ANGLE = -"), (F.col("o_custkey") % 20).cast("string"), F.lit(".5")), "END_GROUP = PRODUCT_PARAMETERS", "GROUP = RADIANCE_SCALING", "SCALING_FACTOR_VNIR = 40", "SCALING_FACTOR_SWIR = 80", "END_GROUP = RADIANCE_SCALING", "END_GROUP = L1_METADATA_FILE", "END_GROUP = L1T"]
    return o.select("o_orderkey", F.concat_ws("\n", *[x if not isinstance(x, str) else F.lit(x) for x in lines]).alias("t"))


@query("""SELECT o_orderkey, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) + 3723000 AS start_millis, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) + 7323000 AS end_millis, CAST(o_orderkey % 360 + 0.25 AS DOUBLE) AS azimuth, CAST(40.5 AS DOUBLE) AS elevation,
    CAST(-(o_custkey % 20 + 0.5) AS DOUBLE) AS look, CAST(120.0 AS DOUBLE) AS scaling FROM orders""")
def acquisition_metadata(spark, d):
    t = image_text(spark, d).select("o_orderkey", codecs.metadata_json(F.col("t")).alias("j"))
    j = F.col("j")
    total = F.aggregate(F.map_values(scalar.radiance_scaling(j)), F.lit(0.0), lambda a, v: a + v)
    return t.select("o_orderkey", scalar.acquisition_start(j).alias("start_millis"), scalar.acquisition_end(j).alias("end_millis"), scalar.sun_azimuth(j).alias("azimuth"), scalar.sun_elevation(j).alias("elevation"), scalar.sensor_look_angle(j).alias("look"), total.alias("scaling"))


# ---- contours


def p95_contours(spark, d):
    k, n = cluster_positions(spark, d)
    c = contour.contours(n, 5, 4, 25, 20).filter("level = 'p95'").withColumn("contour_id", F.xxhash64("polygon"))
    return k, c


@query()
def contour_records(spark, d):
    return rounded(contour.records(p95_contours(spark, d)[1], 25.0, 20.0, NINE_LNG, NINE_LAT).drop("polygon", "level"))


@query()
def contour_score_pairs(spark, d):
    k, c = p95_contours(spark, d)
    clusters = k.groupBy("image_key", "cluster").agg(F.avg("dist2").alias("mahalanobis"))
    return rounded(contour.score_pairs(c, k, clusters))


@query()
def image_contour_tables(spark, d):
    c = contour.records(p95_contours(spark, d)[1], 25.0, 20.0, NINE_LNG, NINE_LAT)
    rows = c.withColumns({"id": F.col("contour_id").cast("string"), "cluster_score": F.col("area_pixels"), "contour_score": F.lit(0.0)})
    return reports.image_contours(rows).select("image_key", F.size("contours").alias("rows"), F.array_join("contours", ";").alias("contours"))


@query("SELECT sha2 AS page, count(DISTINCT page_id) AS images FROM (SELECT page_id, url, sha256(url) AS sha2 FROM pages) GROUP BY 1")
def spectra_pages(spark, d):
    """Pages of equal contents; their names here by SHA-256, which SQL has."""
    p = read(spark, d, "pages").select(F.col("page_id").alias("image_key"), F.col("url").alias("value"))
    return reports.spectra_pages(p).select(F.sha2("value", 256).alias("page"), "images")


@query("SELECT c_custkey AS image_key, string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey) AS clusters, (SELECT count(*) FROM orders) AS orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def image_report(spark, d):
    o = read(spark, d, "orders")
    images = read(spark, d, "customer").select(F.col("c_custkey").alias("image_key"))
    clusters = o.select(F.col("o_custkey").alias("image_key"), F.col("o_orderkey").alias("cluster"), F.col("o_totalprice").alias("score"), F.col("o_orderstatus").alias("style"))
    out = reports.report_rows(images, clusters, o.agg(F.count(F.lit(1)).alias("orders")))
    return out.select("image_key", F.array_join(F.transform("clusters", lambda c: F.concat_ws(":", c["cluster"], c["style"])), ",").alias("clusters"), "orders")


@query("SELECT o_custkey AS cluster, arg_max(o_orderstatus, o_orderkey) AS style FROM orders GROUP BY 1")
def cluster_colors(spark, d):
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("cluster"), F.col("o_orderstatus").alias("style"), "o_orderkey")
    return reports.last_of(o, "cluster", "o_orderkey", "style")


@query("SELECT s_nationkey AS image_key, string_agg('cluster_' || s_suppkey, ',' ORDER BY s_suppkey) AS names FROM supplier GROUP BY 1")
def clusters_by_number(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_nationkey").alias("image_key"), F.concat(F.lit("cluster_"), "s_suppkey").alias("name"))
    number = F.substring_index("name", "_", -1).cast("long")
    return s.groupBy("image_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(number.alias("i"), "name"))), lambda e: e["name"]), ",").alias("names"))


@query("SELECT o_orderkey, substr(coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_clerk END, 'A' || o_orderpriority || o_clerk), 1, 22) AS region FROM orders".replace("o_clerk", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)").replace("o_orderpriority", "CAST(o_custkey AS VARCHAR)"))
def region_key(spark, d):
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    names = F.array(F.lit("Z"), F.concat(F.lit("A"), F.col("o_custkey").cast("string"), date))
    return read(spark, d, "orders").select("o_orderkey", scalar.region_key(F.when(F.col("o_orderkey") % 2 == 0, date), names).alias("region"))


@query("SELECT vec_id, 'Explained variance: ' || (vec_id % 100) || '.5%, ' || (vec_id % 7) || '.0%' AS t FROM embeddings")
def explained_text(spark, d):
    k = F.col("vec_id")
    ratios = F.array(((k % 100) + 0.5) / 100, (k % 7) / F.lit(100.0))
    return read(spark, d, "embeddings").select("vec_id", scalar.explained_text(ratios).alias("t"))


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS directory, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS start, o_totalprice AS radiance FROM orders")
def catalog_records(spark, d):
    """Catalog records as JSON, read again."""
    corners = F.array(F.array(F.lit(1.0), F.lit(2.0)))
    o = read(spark, d, "orders").select("o_orderkey", scalar.catalog_record(F.col("o_orderkey").cast("string"), F.col("o_orderdate").cast("timestamp"), F.col("o_totalprice"), corners).alias("j"))
    v = F.from_json("j", "directory string, acquisition_start long, radiance double, corners array<array<double>>")
    return o.select("o_orderkey", v["directory"].alias("directory"), v["acquisition_start"].alias("start"), v["radiance"].alias("radiance"))


# ---- files and formats


@query(f"WITH {PX} SELECT image_key, CAST(count(*) AS INTEGER) AS pixels, CAST(sum(floor((s[1] + 10) * 1000)) AS BIGINT) AS total FROM px GROUP BY 1")
def sequence_file_roundtrip(spark, d):
    """Each image's first band as a keyed PNG record in a sequence file, read again."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        v = p.sort_values("vec_id")["v"].to_numpy()
        return pd.DataFrame({"key": [f"image-{p['image_key'].iloc[0]}"], "png": [codecs.png_encode(v[None])]})

    v = pixels(spark, d).select("image_key", "vec_id", F.floor((F.element_at("spectrum", 1) + 10) * 1000).alias("v"))
    path = shared_folder(spark, "sequence")
    sequence.write(v.groupBy("image_key").applyInPandas(run, "key string, png binary").select("key", sequence.enveloped(F.col("png"), codecs.PNG).alias("value")), path)
    back = sequence.read_images(spark, path, "image-")
    return back.select(F.substring_index("key", "-", -1).cast("int").alias("image_key"), F.size("samples").alias("pixels"), F.aggregate("samples", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query(f"WITH {PX} SELECT image_key, CAST(count(*) AS INTEGER) AS pixels, CAST(sum(floor((s[1] + 10) * 1000)) AS BIGINT) AS total FROM px GROUP BY 1")
def band_tiff_roundtrip(spark, d):
    def run(p: pd.DataFrame) -> pd.DataFrame:
        v = p.sort_values("vec_id")["v"].to_numpy()
        return pd.DataFrame({"image_key": [p["image_key"].iloc[0]], "tiff": [codecs.tiff_encode(v[None])]})

    v = pixels(spark, d).select("image_key", "vec_id", F.floor((F.element_at("spectrum", 1) + 10) * 1000).alias("v"))
    s = v.groupBy("image_key").applyInPandas(run, "image_key int, tiff binary").select("image_key", codecs.decode_column("tiff")("tiff").alias("r"))
    return s.select("image_key", F.size("r.samples").alias("pixels"), F.aggregate("r.samples", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'B' || (page_id % 50) END AS band FROM pages")
def band_discovery(spark, d):
    k = F.col("page_id")
    path = F.concat(F.lit("/x/EO1_"), F.when(k % 3 == 0, F.lit("MTL")).otherwise(F.concat(F.lit("B"), k % 50)), F.lit("_L1T.TIF"))
    return read(spark, d, "pages").select("page_id", codecs.band_name(path).alias("band"))


@query("SELECT DISTINCT event_type AS directory FROM events WHERE event_type LIKE '%c%'")
def directory_scan(spark, d):
    path = shared_folder(spark, "scan")
    e = read(spark, d, "events").select("event_type", F.col("event_id").cast("string").alias("value")).distinct()
    e.write.partitionBy("event_type").text(path)
    found = codecs.scan_files(spark, path, ".*c.*").select(F.substring_index("directory", "=", -1).alias("directory")).distinct()
    return ingest.pending(found.select(F.col("directory").alias("key")), spark.createDataFrame([], "key string")).select(F.col("key").alias("directory"))


@query("SELECT CAST(event_id AS VARCHAR) AS key, CAST(event_id AS BIGINT) AS k FROM events WHERE event_id % 2 = 0")
def keyed_lines(spark, d):
    """Lines key, tab, JSON, written and read; lines that are no JSON vanish."""
    path, e = shared_folder(spark, "lines"), F.col("event_id")
    line = F.concat(e.cast("string"), F.lit("\t"), F.when(e % 2 == 0, F.to_json(F.struct(e.alias("k")))).otherwise(F.lit("{broken")))
    read(spark, d, "events").select(line.alias("value")).write.text(path)
    return codecs.read_keyed_lines(spark, path, "k long").select("key", F.col("value.k").alias("k")).filter("k is not null")


@query(f"WITH {PX} SELECT f AS form, vec_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM px, unnest(['kml', 'gml', 'gpx', 'georss', 'atom']) AS u(f)")
def markup_roundtrip(spark, d):
    """Pixels as point features in each XML format, read again."""
    p = pixels(spark, d).select("vec_id", F.array(F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))).alias("p"))
    out = None
    for form in ("kml", "gml", "gpx", "georss", "atom"):
        t = p.select(F.lit(form).alias("form"), "vec_id", markup.read(markup.write(F.col("vec_id"), F.lit("a & b"), F.col("p"), form), form)[0].alias("f"))
        t = t.filter("f.name = 'a & b' and f.kind = 'Point'").select("form", "vec_id", F.col("f.points")[0]["x"].alias("x"), F.col("f.points")[0]["y"].alias("y"))
        out = t if out is None else out.unionByName(t)
    return out


@query(f"WITH {POLY}, c AS (SELECT user_id, count(*) AS n FROM v GROUP BY 1) SELECT user_id, round(abs(area), 4) AS area, n AS vertices FROM ar JOIN c USING (user_id)")
def geojson_roundtrip(spark, d):
    p = polygons(spark, d).select("user_id", F.concat(F.lit('{"type": "FeatureCollection", "features": ['), features.to_geojson(F.col("user_id"), F.col("polygon")), F.lit("]}")).alias("t"))
    ring = features.geojson(F.col("t"))[0]["rings"][0]
    open_ = F.slice(ring, 1, F.size(ring) - 1)
    return p.select("user_id", F.round(F.abs(geo.area(open_)), 4).alias("area"), F.size(open_).cast("long").alias("vertices"))


# ---- geometry


@query(f"WITH {POLY} SELECT user_id, round(greatest(abs(area), 0) - 0.5, 4) AS area, round(sum(sqrt((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))) FILTER (NOT last), 4) AS length FROM ar JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1 AS last FROM (SELECT ed.*, row_number() OVER (PARTITION BY user_id) AS rn FROM ed)) USING (user_id) GROUP BY user_id, area".replace("FILTER (NOT last)", ""))
def polygon_with_hole(spark, d):
    """Polygons less a hole of half a unit; the length of their closed edge."""
    p = polygons(spark, d)
    hole = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0))])
    return p.select("user_id", F.round(geo.area_with_holes(F.array("polygon", hole)), 4).alias("area"), F.round(geo.length(geo.closed(F.col("polygon"))), 4).alias("length"))


@query("SELECT p_partkey, p_size > 5 AND p_size < 30 AND p_retailprice > 950 AND p_retailprice < 1500 AND NOT (p_size >= 10 AND p_size <= 20 AND p_retailprice >= 1000 AND p_retailprice <= 1200) AS inside FROM part WHERE p_size NOT IN (5, 30) AND p_retailprice NOT IN (950, 1500)")
def point_in_polygon(spark, d):
    box = lambda a, b, c, e: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((a, b), (c, b), (c, e), (a, e))])
    rings = F.array(box(5, 950, 30, 1500), box(10, 1000, 20, 1200))
    p = read(spark, d, "part").filter("p_size not in (5, 30) and p_retailprice not in (950, 1500)")
    return p.select("p_partkey", geo.contains_with_holes(rings, F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("inside"))


@query("SELECT p_partkey, round(sqrt(pow(greatest(5 - p_size, 0, p_size - 30), 2) + pow(greatest(950 - CAST(p_retailprice AS DOUBLE), 0, CAST(p_retailprice AS DOUBLE) - 1500), 2)), 6) AS distance FROM part")
def polygon_distance(spark, d):
    box = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((5, 950), (30, 950), (30, 1500), (5, 1500))])
    return read(spark, d, "part").select("p_partkey", r6(geo.polygon_distance(F.array(box), F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"))).alias("distance"))


@query("SELECT p_partkey, CAST(CASE WHEN p_size > 0 AND p_size < 40 THEN 2 ELSE 1 END AS INTEGER) AS parts, CAST(40 AS DOUBLE) AS length FROM part WHERE p_size NOT IN (0, 40)")
def line_split(spark, d):
    """A line of 40 cut by an upright one at p_size."""
    at = lambda *xy: F.array(*[F.struct(F.lit(x).cast("double").alias("x") if not isinstance(x, F.Column) else x.cast("double").alias("x"), F.lit(float(y)).alias("y")) for x, y in xy])
    p = read(spark, d, "part").filter("p_size not in (0, 40)").select("p_partkey", geo.split(at((0, 0), (40, 0)), at((F.col("p_size"), -1), (F.col("p_size"), 1))).alias("parts"))
    total = F.aggregate(F.transform("parts", geo.length), F.lit(0.0), lambda a, v: a + v)
    return p.select("p_partkey", F.size("parts").alias("parts"), F.round(total, 6).alias("length"))


@query(f"WITH {POLY}, b AS (SELECT user_id, min(x1) AS l, max(x1) AS r, min(y1) AS b, max(y1) AS t FROM ed GROUP BY 1) SELECT user_id, round(perimeter * 3, 3) AS length, round(abs(area) * 5, 3) AS area, round(l, 4) AS left, round(r * 2 - l, 4) AS right, round(b, 4) AS bottom, round(t * 2 - b, 4) AS top FROM ar JOIN b USING (user_id) WHERE abs(area) > 1")
def collection_measures(spark, d):
    """Each polygon together with itself twice as large, grown from its lower left corner."""
    p = polygons(spark, d).filter(F.abs(geo.area(F.col("polygon"))) > 1)
    b = geo.bounds(F.col("polygon"))
    p = p.withColumn("two", geo.moved(F.col("polygon"), lambda x, y: (b["left"] + 2 * (x - b["left"]), b["bottom"] + 2 * (y - b["bottom"]))))
    c = geo.collection(F.array("polygon", "two"))
    return p.select("user_id", F.round(c["length"], 3).alias("length"), F.round(c["area"], 3).alias("area"), *[F.round(c[n], 4).alias(n) for n in ("left", "right", "bottom", "top")])


@query(f"WITH {POLY} SELECT user_id, round(abs(area) * 18, 3) AS area, round(perimeter, 3) AS turned FROM ar")
def polygon_moved(spark, d):
    p = polygons(spark, d)
    return p.select("user_id", F.round(F.abs(geo.area(geo.resized(F.col("polygon"), 3.0, 1.0, 2.0, 2.0))), 3).alias("area"), F.round(geo.perimeter(geo.rotated(F.col("polygon"), 30.0, 1.0, 1.0)), 3).alias("turned"))


@query("SELECT p_partkey, round(0.5 * n * p_size * p_size * sin(2 * pi() / n), 5) AS area FROM part, (SELECT 7 AS n)")
def regular_polygons(spark, d):
    size = F.col("p_size").cast("double")
    return read(spark, d, "part").select("p_partkey", F.round(F.abs(geo.area(geo.regular_polygon(F.lit(1.0), F.lit(2.0), size, 7))), 5).alias("area"))


@query(f"WITH {LL} SELECT vec_id, round(2 * 6378.137 * atan2(sqrt(h), sqrt(1 - h)), 5) AS km FROM (SELECT vec_id, pow(sin(radians(50 - lat) / 2), 2) + pow(sin(radians(10 - lng) / 2), 2) * cos(radians(lat)) * cos(radians(50)) AS h FROM ll)")
def geodesic_length(spark, d):
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    line = F.array(at(F.col("lng"), F.col("lat")), at(F.lit(10.0), F.lit(50.0)))
    return located(spark, d).select("vec_id", F.round(geo.geodesic_length_km(line), 5).alias("km"))


@query(f"WITH {LL} SELECT vec_id, true AS close FROM ll")
def vincenty_destination(spark, d):
    """The place at a bearing and distance lies at that distance again."""
    p = located(spark, d).withColumn("to", geo.destinations(F.col("lng"), F.col("lat"), F.lit(30.0), F.lit(5000.0)))
    km = geo.vincenty(F.col("lng"), F.col("lat"), F.col("to.lng"), F.col("to.lat"))
    return p.select("vec_id", (F.abs(km - 5.0) < 1e-5).alias("close"))


# ---- filters

TREE = "(value > 50 AND event_type LIKE 'c*') OR (NOT (user_id BETWEEN 10 AND 60) AND NOT (value IS NULL))"


@query("SELECT event_id FROM events WHERE (value > 50 AND event_type ILIKE 'c%') OR NOT (user_id BETWEEN 10 AND 60) AND value IS NOT NULL")
def cql_written(spark, d):
    """A filter that was parsed, written and parsed again."""
    return read(spark, d, "events").filter(cql.column(cql.parse(cql.write(cql.parse(TREE))))).select("event_id")


@query("SELECT event_id FROM events WHERE event_id IN (1, 5, 9, 100000000)")
def feature_id_filter(spark, d):
    e = read(spark, d, "events").withColumn("fid", F.col("event_id").cast("string"))
    return e.filter(cql.column({"op": "FID", "values": ["1", "5", "9", "100000000"]})).select("event_id")


@query("SELECT event_id FROM events WHERE starts_with(event_type, 'c')")
def function_filter(spark, d):
    return read(spark, d, "events").filter(cql.function("startswith", F.col("event_type"), F.lit("c"))).select("event_id")


SQL["connected_components"] = f"""WITH RECURSIVE {PX}, c AS (SELECT y, x, y * 25 + x AS id FROM px WHERE s[1] > 0), r(y, x, id) AS (SELECT y, x, id FROM c UNION SELECT c.y, c.x, r.id FROM r JOIN c ON abs(c.y - r.y) <= 1 AND abs(c.x - r.x) <= 1),
    l AS (SELECT y, x, min(id) AS low FROM r GROUP BY 1, 2), n AS (SELECT *, dense_rank() OVER (ORDER BY low) AS region, count(*) OVER (PARTITION BY low) AS size FROM l)
    SELECT 0 AS image_key, 0 AS cluster, y, x, CAST(region AS INTEGER) AS region, CAST(size AS INTEGER) AS size FROM n WHERE size >= 2"""


# ---- streams


def page_stream(spark, d):
    return stream(spark, d, "pages").select(F.col("page_id").cast("string").alias("key"))


@query("SELECT CAST(page_id AS VARCHAR) AS key, CAST(1 AS INTEGER) AS attempts, page_id % 5 <> 0 AS ok, CASE WHEN page_id % 5 <> 0 THEN 'f' || page_id ELSE '' END AS file FROM pages")
def stream_status(spark, d):
    """The status table after a scan in which every fifth conversion fails; a replay changes nothing."""
    base = shared_folder(spark, "status")

    def convert(todo):
        ok = F.col("key").cast("long") % 5 != 0
        return todo.select("key", ok.alias("ok"), F.when(ok, F.concat(F.lit("f"), "key")).alias("file"))

    for _ in range(2):  # without its checkpoint the stream replays from its start
        ingest.ingest(page_stream(spark, d), f"{base}/status", convert, f"{base}/ck", tasks=4).awaitTermination()
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/ck")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return ingest.latest(spark, f"{base}/status")


@query(SQL["gray_band_stats"])
def stream_statistics(spark, d):
    """Images that arrive as a stream, with three named outputs; the statistics are returned."""
    base, px = shared_folder(spark, "statistics"), pixels(spark, d)
    s = stream(spark, d, "embeddings")
    outputs = {
        "catalog": (f"{base}/catalog", lambda done: done.select("key", "file")),
        "fileNames": (f"{base}/names", lambda done: done.select("file")),
        "summaryStatistics": (f"{base}/statistics", lambda done: stats.gray_band_stats(px.join(done.select(F.col("key").cast("int").alias("image_key")), "image_key"))),
    }
    convert = lambda todo: todo.select("key", F.lit(True).alias("ok"), F.concat(F.lit("image-"), "key").alias("file"))
    ingest.ingest(s.select(F.col("label").cast("string").alias("key")), f"{base}/status", convert, f"{base}/ck", outputs=outputs).awaitTermination()
    return rounded(spark.read.parquet(f"{base}/statistics").drop("stream", "batch"))
