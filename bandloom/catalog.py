"""Registered queries over the driver's tables, each with DuckDB SQL where SQL can express it.

The embeddings table stands for images: label = image, vec_id = pixel on a grid 25 wide, element = band.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import scalar
from .operators import cluster, contour, geo, linalg, raster, stats
from .plans import cql, reports
from .sources import codecs, features, kv
from .sources.tables import pixels, read, tall
from .streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
PX = "px AS (SELECT label AS image_key, vec_id, CAST(vec_id // 25 AS INTEGER) AS y, CAST(vec_id % 25 AS INTEGER) AS x, CAST(embedding AS DOUBLE[]) AS s FROM embeddings)"
TALL = PX + ", t AS (SELECT image_key, vec_id, y, x, unnest(s) AS v, generate_subscripts(s, 1) AS band FROM px)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def unsigned_zero(df: DataFrame, c: str) -> DataFrame:
    """-0.0 as 0.0."""
    return df.withColumn(c, F.col(c) + F.lit(0.0))


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


GRAY = PX + """, g AS (SELECT image_key, list_sum(list_transform(s, lambda v: v * v)) AS gray FROM px),
    c AS (SELECT image_key, quantile_cont(gray, 0.99) AS cut, count(*) AS n FROM g GROUP BY 1),
    k AS (SELECT g.image_key, gray, n FROM g JOIN c USING (image_key) WHERE gray < cut)"""


@query(f"""WITH {GRAY}, m AS (SELECT image_key, avg(gray) AS mean, stddev_pop(gray) AS sigma FROM k GROUP BY 1)
    SELECT image_key, first(n) AS num_pixels, round(first(mean), 6) AS mean, round(first(sigma), 6) AS sigma,
      round(sum(CASE WHEN gray > mean + sigma THEN 1 ELSE 0 END) / first(n), 6) AS plus_one_sigma,
      round(sum(CASE WHEN gray < mean - sigma THEN 1 ELSE 0 END) / first(n), 6) AS minus_one_sigma
    FROM k JOIN m USING (image_key) GROUP BY image_key""")
def gray_band_stats(spark, d):
    return rounded(stats.gray_band_stats(pixels(spark, d)))


HIST = """ends AS (SELECT k, min(v) AS lo, max(v) AS hi FROM src GROUP BY k),
    cnt AS (SELECT k, CAST(least(floor((v - lo) / ((hi - lo) / {b})), {b} - 1) AS INTEGER) AS bin, count(*) AS n FROM src JOIN ends USING (k) GROUP BY 1, 2),
    h AS (SELECT ends.k, CAST(g.bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM ends CROSS JOIN range({b}) AS g(bin) LEFT JOIN cnt ON cnt.k = ends.k AND cnt.bin = g.bin)"""


@query(f"WITH {GRAY}, src AS (SELECT image_key AS k, gray AS v FROM k), {HIST.format(b=100)} SELECT k AS image_key, bin, n FROM h")
def gray_band_histogram(spark, d):
    p = pixels(spark, d).select("image_key", stats.gray(F.col("spectrum")).alias("gray"))
    return stats.histogram(stats.trimmed(p), "image_key", "gray")


EVENTS = "src AS (SELECT event_type AS k, value AS v FROM events WHERE value IS NOT NULL)"


def event_histogram(spark, d, bins=100):
    return stats.histogram(read(spark, d, "events").filter("value is not null"), "event_type", "value", bins)


PEAKS = "WITH {e}, {h} SELECT k AS event_type, bin, n FROM (SELECT *, {f}(n) OVER (PARTITION BY k ORDER BY bin ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS m FROM h) WHERE n = m"


@query(PEAKS.format(e=EVENTS, h=HIST.format(b=100), f="max"))
def histogram_peaks(spark, d):
    return stats.peaks(event_histogram(spark, d), "event_type")


@query(PEAKS.format(e=EVENTS, h=HIST.format(b=100), f="min"))
def histogram_valleys(spark, d):
    return stats.peaks(event_histogram(spark, d), "event_type", valley=True)


COV = "WITH " + TALL + " SELECT {k} CAST(a.band AS INTEGER) AS band_a, CAST(b.band AS INTEGER) AS band_b, round(covar_samp(a.v, b.v), 6) + 0.0 AS cov FROM t a JOIN t b ON a.vec_id = b.vec_id GROUP BY {g} a.band, b.band"


def first_bands(spark, d, n):
    return pixels(spark, d).withColumn("spectrum", F.slice("spectrum", 1, n))


@query(COV.format(k="0 AS key,", g=""))
def band_covariance(spark, d):
    return unsigned_zero(rounded(linalg.covariance(pixels(spark, d).withColumn("all", F.lit(0)), "all")), "cov")


@query(COV.format(k="a.image_key AS key,", g="a.image_key,"))
def region_covariance(spark, d):
    return unsigned_zero(rounded(linalg.covariance(pixels(spark, d), "image_key")), "cov")


@query(f"WITH {TALL} SELECT image_key, CAST(band AS INTEGER) AS band, round(sum(v), 6) AS total, round(stddev_pop(v), 6) AS sd FROM t GROUP BY 1, 2 HAVING sum(v) <> 0 AND stddev_pop(v) > 1e-6")
def band_zero_variance(spark, d):
    return rounded(raster.usable_bands(pixels(spark, d)))


@query(f"""WITH {TALL} SELECT vec_id, CAST(band AS INTEGER) AS band, round(ln(abs(v) * 0.025 / (2.5e-28 / (exp(0.0143878 / ((400 + 10 * band) * 1e-9) / 5778) - 1) / pow((400 + 10 * band) * 1e-9, 5)) + 1e-6), 6) AS value FROM t""")
def log_normalize(spark, d):
    t = tall(pixels(spark, d))
    return t.select("vec_id", "band", r6(raster.normalize(F.abs("value"), F.lit(0.025), (F.lit(400) + 10 * F.col("band")).cast("double"))).alias("value"))


@query(f"WITH {PX} SELECT vec_id, list_max(s) > 0 AS in_mask FROM px")
def union_mask(spark, d):
    return raster.union_mask(pixels(spark, d)).select("vec_id", "in_mask")


def grid_mask(spark, d):
    return raster.union_mask(first_bands(spark, d, 5)).withColumn("image_key", F.lit(0))


ROLL = "WITH " + PX + """, m AS (SELECT vec_id, y, x, list_max(s[1:5]) > 0 AS ok FROM px)
    SELECT a.vec_id FROM m a WHERE a.ok AND NOT EXISTS (SELECT 1 FROM m h WHERE NOT h.ok AND {c})"""


@query(ROLL.format(c="abs(h.y - a.y) + abs(h.x - a.x) <= 2"))
def roll_mask(spark, d):
    return raster.erode(grid_mask(spark, d), 20, 25).select("vec_id")


@query(ROLL.format(c="least(abs(h.y - a.y), 400 - abs(h.y - a.y)) + least(abs(h.x - a.x), 25 - abs(h.x - a.x)) <= 2"))
def roll_mask_wrapped(spark, d):
    return raster.erode(grid_mask(spark, d), 400, 25, wrap=True).select("vec_id")


FLAT = "quantized AS (SELECT image_key, vec_id, y, x, band, floor(v * 0.4) AS v FROM t WHERE band <= 4)"


@query(f"""WITH {TALL}, {FLAT}, bad_y AS (SELECT DISTINCT y FROM (SELECT y, band FROM quantized GROUP BY y, band HAVING stddev_pop(v) < 1e-6)),
    bad_x AS (SELECT DISTINCT x FROM (SELECT x, band FROM quantized GROUP BY x, band HAVING stddev_pop(v) < 1e-6))
    SELECT vec_id FROM px WHERE y NOT IN (SELECT y FROM bad_y) AND x NOT IN (SELECT x FROM bad_x)""")
def fix_mask(spark, d):
    p = pixels(spark, d).withColumns({"image_key": F.lit(0), "spectrum": F.transform(F.slice("spectrum", 1, 4), lambda v: F.floor(v * 0.4).cast("double"))})
    return raster.fix_mask(p).select("vec_id")


@query(f"""WITH {PX}, m AS (SELECT image_key, y, x FROM px WHERE s[1] > 0.5), e AS (SELECT *, min(x) OVER w AS x0, max(x) OVER w AS x1, min(y) OVER w AS y0, max(y) OVER w AS y1 FROM m WINDOW w AS (PARTITION BY image_key)),
    f AS (SELECT image_key, min(x) AS left_x, floor(avg(CASE WHEN x = x0 THEN y END) + 0.5) AS left_y, floor(avg(CASE WHEN y = y0 THEN x END) + 0.5) AS top_x, min(y) AS top_y,
      max(x) AS right_x, floor(avg(CASE WHEN x = x1 THEN y END) + 0.5) AS right_y, floor(avg(CASE WHEN y = y1 THEN x END) + 0.5) AS bottom_x, max(y) AS bottom_y FROM e GROUP BY image_key)
    SELECT k.image_key, {", ".join(f"CAST(coalesce({c}, -1) AS BIGINT) AS {c}" for c in ("left_x", "left_y", "top_x", "top_y", "right_x", "right_y", "bottom_x", "bottom_y"))}
    FROM (SELECT DISTINCT image_key FROM px) k LEFT JOIN f USING (image_key)""")
def mask_corners(spark, d):
    return raster.corners(pixels(spark, d).withColumn("in_mask", F.element_at("spectrum", 1) > 0.5))


@query(f"WITH {TALL}, b AS (SELECT image_key, band, avg(v) AS m FROM t GROUP BY 1, 2) SELECT image_key, round(greatest(0.0, max(m)), 6) AS max_avg_radiance FROM b GROUP BY 1")
def max_average_radiance(spark, d):
    return rounded(raster.average_radiance(pixels(spark, d)))


def band_pair(spark, d):
    p = pixels(spark, d)
    return p.select("vec_id", F.slice("spectrum", 1, 32).alias("p"), F.slice("spectrum", 33, 32).alias("q"))


ARITH = "WITH " + TALL + " SELECT a.vec_id, CAST(a.band AS INTEGER) AS band, round({e}, 6) AS value FROM t a JOIN t b ON a.vec_id = b.vec_id AND b.band = a.band + 32"


def _arith(df, c):
    return df.select("vec_id", F.posexplode(c).alias("band", "value")).select("vec_id", (F.col("band") + 1).alias("band"), r6("value").alias("value"))


@query(ARITH.format(e="2.0 * a.v + 0.5 * b.v"))
def band_add(spark, d):
    return _arith(band_pair(spark, d), raster.add(F.lit(2.0), F.col("p"), F.lit(0.5), F.col("q")))


@query(ARITH.format(e="a.v * b.v"))
def band_mul(spark, d):
    return _arith(band_pair(spark, d), raster.multiply(F.col("p"), F.col("q")))


@query(ARITH.format(e="CASE WHEN b.v > 0 THEN a.v / b.v ELSE 0.0 END"))
def band_div(spark, d):
    return _arith(band_pair(spark, d), raster.divide(F.col("p"), F.col("q")))


@query(f"WITH {PX} SELECT vec_id, round(CASE WHEN s[1] > 0 THEN s[2] ELSE 0.0 END, 6) AS value FROM px")
def mask_scatter(spark, d):
    p = pixels(spark, d)
    kept = p.filter(F.element_at("spectrum", 1) > 0).select("image_key", "y", "x", F.element_at("spectrum", 2).alias("value"))
    return raster.unmask(p.select("image_key", "y", "x", "vec_id"), kept).select("vec_id", r6("value").alias("value"))


@query(f"""WITH {PX}, e AS (SELECT image_key, vec_id, exp(s[10]) AS r, exp(s[20]) AS g, exp(s[30]) AS b FROM px),
    m AS (SELECT image_key, least(min(r), min(g), min(b)) AS lo, greatest(max(r), max(g), max(b)) AS hi FROM e GROUP BY 1)
    SELECT image_key, vec_id, CAST(floor(255 * (r - lo) / (hi - lo)) AS INTEGER) AS r, CAST(floor(255 * (g - lo) / (hi - lo)) AS INTEGER) AS g, CAST(floor(255 * (b - lo) / (hi - lo)) AS INTEGER) AS b FROM e JOIN m USING (image_key)""")
def rgb_stretch(spark, d):
    return raster.rgb_stretch(pixels(spark, d), raster.rgb_bands(range(10, 65, 10), (10, 20, 30)))


MEANS = "m AS (SELECT image_key, band, avg(v) AS m FROM t GROUP BY 1, 2)"
BASIS = [[1.0 if i == k else 0.5 if i == k + 1 else 0.0 for i in range(64)] for k in range(3)]


@query(f"""WITH {TALL}, {MEANS}, c AS (SELECT vec_id, band, v - m AS u FROM t JOIN m USING (image_key, band))
    SELECT vec_id, CAST(k AS INTEGER) AS component, round(sum(u * CASE WHEN band = k THEN 1.0 WHEN band = k + 1 THEN 0.5 ELSE 0.0 END), 6) AS value FROM c, range(1, 4) AS g(k) GROUP BY 1, 2""")
def project_fixed_basis(spark, d):
    p = pixels(spark, d)
    m = linalg.means(tall(p))
    out = p.join(m, "image_key").select("vec_id", F.posexplode(linalg.project(F.col("spectrum"), F.col("mean"), BASIS)).alias("k", "value"))
    return out.select("vec_id", (F.col("k") + 1).alias("component"), r6("value").alias("value"))


def ten_centers(spark, d, bands=4):
    """The spectra of the ten lowest pixels."""
    rows = pixels(spark, d).filter("vec_id < 10").orderBy("vec_id").select(F.slice("spectrum", 1, bands).alias("s")).collect()
    return [r["s"] for r in rows]


def assigned(spark, d):
    return cluster.assign(pixels(spark, d), ten_centers(spark, d), 4)


ASSIGN = PX + """, ce AS (SELECT CAST(vec_id AS INTEGER) AS cluster, s[1:4] AS c FROM px WHERE vec_id < 10),
    dist AS (SELECT px.vec_id, px.image_key, s, cluster, c, (s[1]-c[1])*(s[1]-c[1]) + (s[2]-c[2])*(s[2]-c[2]) + (s[3]-c[3])*(s[3]-c[3]) + (s[4]-c[4])*(s[4]-c[4]) AS dist2 FROM px CROSS JOIN ce),
    a AS (SELECT * FROM dist QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist2, cluster) = 1)"""


@query(f"WITH {ASSIGN} SELECT vec_id, cluster, round(dist2, 6) AS dist2 FROM a")
def kmeans_assign(spark, d):
    return rounded(assigned(spark, d).select("vec_id", "cluster", "dist2"))


@query(f"WITH {ASSIGN}, u AS (SELECT cluster, unnest(s[1:4]) AS v, generate_subscripts(s[1:4], 1) AS band FROM a) SELECT cluster, CAST(band AS INTEGER) AS band, count(*) AS n, round(avg(v), 6) AS center FROM u GROUP BY 1, 2")
def kmeans_update(spark, d):
    return rounded(cluster.update(assigned(spark, d)))


@query(f"WITH {ASSIGN} SELECT cluster, count(*) AS n FROM a GROUP BY 1")
def cluster_population(spark, d):
    return assigned(spark, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ASSIGN} SELECT round(sqrt(sum(dist2)), 6) AS quality FROM a")
def cluster_quality(spark, d):
    return rounded(cluster.quality(assigned(spark, d)))


@query(f"WITH {PX} SELECT vec_id, round(s[1]*s[1]/4.0 + s[2]*s[2]/2.0 + s[3]*s[3]/1.0 + s[4]*s[4]/0.5, 6) AS m2 FROM px")
def mahalanobis_sq(spark, d):
    return pixels(spark, d).select("vec_id", r6(cluster.mahalanobis2(F.slice("spectrum", 1, 4), F.array(*map(F.lit, (4.0, 2.0, 1.0, 0.5))))).alias("m2"))


@query(f"""WITH {TALL}, rows AS (SELECT y, row_number() OVER (ORDER BY y) AS up, row_number() OVER (ORDER BY y DESC) AS down FROM (SELECT DISTINCT y FROM px)),
    n AS (SELECT y, x, band, lead(v) OVER (PARTITION BY y, band ORDER BY x) - v AS diff FROM t)
    SELECT y, x, CAST(band AS INTEGER) AS band, round(diff, 6) + 0.0 AS diff FROM n JOIN rows USING (y) WHERE up > 2 AND down > 2 AND diff IS NOT NULL""")
def noise_difference(spark, d):
    return unsigned_zero(rounded(raster.noise_difference(pixels(spark, d).withColumn("image_key", F.lit(0)), skip=2).select("y", "x", "band", "diff")), "diff")


SCORED = ASSIGN + ", sc AS (SELECT vec_id, image_key, cluster, dist2, c[1]*c[1]/4.0 + c[2]*c[2]/2.0 + c[3]*c[3]/1.0 + c[4]*c[4]/0.5 AS mahalanobis FROM a)"


def scored(spark, d):
    centers = ten_centers(spark, d)
    table = F.array(*[F.array(*map(F.lit, c)) for c in centers])
    m2 = cluster.mahalanobis2(F.get(table, F.col("cluster")), F.array(*map(F.lit, (4.0, 2.0, 1.0, 0.5))))
    return cluster.assign(pixels(spark, d), centers, 4).withColumn("mahalanobis", m2)


@query(f"""WITH {SCORED}, o AS (SELECT *, row_number() OVER (PARTITION BY image_key ORDER BY mahalanobis DESC, dist2 DESC, vec_id) AS rank, count(*) OVER (PARTITION BY image_key) AS n FROM sc)
    SELECT image_key, vec_id, cluster, CAST(rank AS INTEGER) AS rank FROM o WHERE rank <= round(n * 0.1)""")
def anomaly_top_fraction(spark, d):
    return cluster.anomalies(scored(spark, d), 0.1).select("image_key", "vec_id", "cluster", "rank")


POS = PX + ", hh AS (SELECT image_key, CAST(least(floor(x * 5 / 25), 4) AS INTEGER) AS ix, CAST(least(floor(y * 4 / 20), 3) AS INTEGER) AS iy, count(*) AS n FROM px GROUP BY 1, 2, 3)"


def positions(spark, d):
    return stats.position_histogram(pixels(spark, d), "image_key", 25, 20, 5)


@query(f"WITH {POS} SELECT * FROM hh")
def position_histogram2d(spark, d):
    return positions(spark, d)


@query(f"WITH {POS} SELECT image_key, round(quantile_cont(n, 0.5), 6) AS cut50, round(quantile_cont(n, 0.95), 6) AS cut95 FROM hh GROUP BY 1")
def cut_levels(spark, d):
    return rounded(stats.cut_levels(positions(spark, d), "image_key"))


QUANT = """ds AS (SELECT DISTINCT value AS s FROM events WHERE value IS NOT NULL), cut AS (SELECT quantile_cont(s, 0.99) AS c FROM ds),
    q AS (SELECT CAST(500 + 50 * i AS INTEGER) AS quantile, (SELECT list_extract(quantile_cont(least(s, c), [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0]), CAST(i + 1 AS INTEGER)) FROM ds, cut) AS score FROM range(11) AS g(i))"""


@query(f"WITH {QUANT} SELECT quantile, round(score, 6) AS score FROM q")
def score_quantiles(spark, d):
    return rounded(stats.score_quantiles(read(spark, d, "events"), "value"))


@query(f"""WITH {QUANT}, w AS (SELECT score, quantile, lead(score) OVER (ORDER BY score, quantile) AS s2, lead(quantile) OVER (ORDER BY score, quantile) AS q2, min(score) OVER () AS lo, max(score) OVER () AS hi FROM q)
    SELECT event_id, round(CASE WHEN value < lo THEN 0.0 WHEN value >= hi THEN 1000.0 ELSE (SELECT max(quantile + (q2 - quantile) * (value - score) / (s2 - score)) FROM w w2 WHERE w2.score <= value AND value < w2.s2) END, 6) AS norm
    FROM events, (SELECT DISTINCT lo, hi FROM w)""")
def normalized_score(spark, d):
    e = read(spark, d, "events")
    return rounded(stats.normalized(e.select("event_id", "value"), "value", stats.score_quantiles(e, "value")).select("event_id", "norm"))


@query("SELECT event_id AS id, value AS cluster_score, CAST(user_id AS DOUBLE) AS contour_score FROM events ORDER BY value DESC NULLS LAST, user_id DESC, event_id LIMIT 10")
def top10_contours(spark, d):
    e = read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("value").alias("cluster_score"), F.col("user_id").cast("double").alias("contour_score"))
    return reports.top_contours(e)


SIM = EVENTS + ", " + HIST.format(b=20) + """, pairs AS (SELECT p.k AS a, q.k AS b, corr(p.n, q.n) AS correlation,
      0.5 * sum(CASE WHEN p.n + q.n > 0 THEN pow(p.n - q.n, 2) / (p.n + q.n) ELSE 0.0 END) AS chi2 FROM h p JOIN h q ON p.bin = q.bin AND p.k <> q.k GROUP BY 1, 2)"""


@query(f"WITH {SIM} SELECT a, b, round(correlation, 6) AS correlation, round(chi2, 6) AS chi2 FROM pairs")
def hist_similarity(spark, d):
    return rounded(stats.similarity(event_histogram(spark, d, 20), "event_type"))


@query(f"""WITH {SIM.replace("event_type AS k", "CAST(user_id % 7 AS INTEGER) AS k")}, m AS (SELECT a, round(avg(correlation), 9) AS c, round(avg(chi2), 9) AS x FROM pairs GROUP BY a)
    SELECT (SELECT a FROM m WHERE c > 0 ORDER BY c DESC, a LIMIT 1) AS by_correlation, (SELECT a FROM m WHERE x > 0 ORDER BY x DESC, a LIMIT 1) AS by_chi2""")
def outlier_group(spark, d):
    e = read(spark, d, "events").filter("value is not null").withColumn("k", (F.col("user_id") % 7).cast("int"))
    return stats.outliers(stats.similarity(stats.histogram(e, "k", "value", 20), "k"))


# nine points of an invented image 25 x 20
NINE_LNG = dict(tl=10.0, tm=10.11, tr=10.2, ml=10.02, mm=10.12, mr=10.23, bl=10.05, bm=10.15, br=10.26)
NINE_LAT = dict(tl=50.2, tm=50.21, tr=50.19, ml=50.1, mm=50.11, mr=50.09, bl=50.0, bm=50.02, br=49.99)


def _taylor(p: dict) -> str:
    u, v = "((x - 12.5) / 25.0)", "((y - 10.0) / 20.0)"
    return f"{p['mm']} + {u}*({p['mr']} - {p['ml']}) + {v}*({p['tm']} - {p['bm']}) + {u}*{u}*2*({p['mr']} - 2*{p['mm']} + {p['ml']}) + {v}*{v}*2*({p['tm']} - 2*{p['mm']} + {p['bm']}) + {u}*{v}*({p['tr']} - {p['br']} - {p['tl']} + {p['bl']})"


def located(spark, d):
    p = pixels(spark, d)
    return p.select("vec_id", *[geo.lnglat(F.col("x"), F.col("y"), 25.0, 20.0, n).alias(c) for c, n in (("lng", NINE_LNG), ("lat", NINE_LAT))])


LL = PX + f", ll AS (SELECT vec_id, CAST({_taylor(NINE_LNG)} AS DOUBLE) AS lng, CAST({_taylor(NINE_LAT)} AS DOUBLE) AS lat FROM px)"


@query(f"WITH {LL} SELECT vec_id, round(lng, 6) AS lng, round(lat, 6) AS lat FROM ll")
def pixel_to_lnglat(spark, d):
    return rounded(located(spark, d))


_E2 = "((pow(6378.137::DOUBLE, 2) - pow(6356.7523142::DOUBLE, 2)) / pow(6378.137::DOUBLE, 2))"


@query(f"""WITH {LL} SELECT vec_id, round((lng - 10.12) * pi()*6378.137::DOUBLE/180*cos(radians(50.11)) / sqrt(1 - {_E2}*pow(sin(radians(50.11)), 2)) * 1000, 4) AS east,
    round((lat - 50.11) * pi()*6378.137::DOUBLE*(1 - {_E2})/180 / pow(1 - {_E2}*pow(sin(radians(50.11)), 2), 1.5) * 1000, 4) AS north FROM ll""")
def lnglat_to_meters(spark, d):
    east, north = geo.meters(F.col("lng"), F.col("lat"), F.lit(10.12), F.lit(50.11))
    return located(spark, d).select("vec_id", F.round(east, 4).alias("east"), F.round(north, 4).alias("north"))


def polygons(spark, d):
    """A polygon for each user: their events in time, (value, k of props)."""
    e = read(spark, d, "events").filter("value is not null and ts is not null")
    p = F.struct("ts", "event_id", F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"))
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_list(p)).alias("p"))
    return g.select("user_id", F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("polygon"))


POLY = """v AS (SELECT user_id, value AS x1, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y1, ts, event_id FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
    ed AS (SELECT user_id, x1, y1, coalesce(lead(x1) OVER w, first_value(x1) OVER w) AS x2, coalesce(lead(y1) OVER w, first_value(y1) OVER w) AS y2 FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    ar AS (SELECT user_id, sum(x1*y2 - x2*y1) * 0.5 AS area, sum(sqrt((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))) AS perimeter, sum((x1+x2)*(x1*y2-x2*y1)) AS cx, sum((y1+y2)*(x1*y2-x2*y1)) AS cy FROM ed GROUP BY 1)"""


@query(f"WITH {POLY} SELECT user_id, round(area, 4) + 0.0 AS area FROM ar")
def polygon_area(spark, d):
    return polygons(spark, d).select("user_id", (F.round(geo.area(F.col("polygon")), 4) + 0.0).alias("area"))


@query(f"WITH {POLY} SELECT user_id, round(perimeter, 4) AS perimeter FROM ar")
def polygon_perimeter(spark, d):
    return polygons(spark, d).select("user_id", F.round(geo.perimeter(F.col("polygon")), 4).alias("perimeter"))


@query(f"WITH {POLY} SELECT user_id, round(cx / (6 * area), 4) AS x, round(cy / (6 * area), 4) AS y FROM ar WHERE abs(area) > 1")
def polygon_centroid(spark, d):
    c = geo.centroid(F.col("polygon"))
    return polygons(spark, d).filter(F.abs(geo.area(F.col("polygon"))) > 1).select("user_id", F.round(c["x"], 4).alias("x"), F.round(c["y"], 4).alias("y"))


@query("SELECT o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def pending_ingest(spark, d):
    known = read(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("key"))
    return ingest.pending(read(spark, d, "orders").select(F.col("o_orderkey").alias("key")), known)


@query("SELECT o_orderkey AS key, CAST(o_orderkey % 6 AS INTEGER) AS attempts FROM orders WHERE o_orderkey % 6 < 4 AND o_orderstatus <> 'F'")
def retry_ingest(spark, d):
    s = read(spark, d, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 6).cast("int").alias("attempts"), (F.col("o_orderstatus") == "F").alias("ok"))
    return ingest.retries(s).select("key", "attempts")


def order_catalog(spark, d):
    corners = F.array(*[F.array((F.col("o_custkey") % 90).cast("double") + dx, (F.col("o_orderkey") % 45).cast("double") + dy) for dx, dy in ((0, 0), (0, 1), (1, 0), (1, 1))])
    return read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("directory"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("acquisition_start"), F.col("o_totalprice").alias("radiance"), corners.alias("corners"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS directory, epoch_ms(o_orderdate) AS acquisition_start, o_totalprice AS radiance FROM orders
    WHERE o_totalprice BETWEEN 1000 AND 200000 AND epoch_ms(o_orderdate) BETWEEN 0 AND 852076800000 AND sqrt(pow(o_custkey % 90 + 0.5 - 40, 2) + pow(o_orderkey % 45 + 0.5 - 20, 2)) < 15""")
def catalog_filter(spark, d):
    return reports.catalog_filter(order_catalog(spark, d), (1000, 200000), (0, 852076800000), 40.0, 20.0, 15.0).drop("corners")


@query("SELECT least(min(o_totalprice), 0.0) AS min_radiance, max(o_totalprice) AS max_radiance, epoch_ms(min(o_orderdate)) AS min_time, epoch_ms(max(o_orderdate)) AS max_time FROM orders")
def catalog_bounds(spark, d):
    return reports.catalog_bounds(order_catalog(spark, d))


@query("SELECT CAST(user_id AS VARCHAR) AS key, arg_min(props, event_id) AS value FROM events GROUP BY user_id")
def kv_first_value(spark, d):
    e = read(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"), "event_id")
    return kv.first_values(e, "event_id")


@query("SELECT CAST(event_id AS VARCHAR) AS key, props AS value FROM events WHERE event_id IN (SELECT DISTINCT user_id FROM events)")
def kv_lookup(spark, d):
    e = read(spark, d, "events")
    return kv.lookup(e.select(F.col("user_id").cast("string").alias("key")), e.select(F.col("event_id").cast("string").alias("key"), F.col("props").alias("value")))


def shared_folder(spark, name):
    """A new folder that all executors share: below spark.checkpoint.dir, or a temporary one in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="bandloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@query("SELECT CAST(event_id AS VARCHAR) AS key FROM events WHERE CAST(event_id AS VARCHAR) BETWEEN '100' AND '300'")
def kv_range_scan(spark, d):
    path = shared_folder(spark, "kv")
    kv.put(read(spark, d, "events").select(F.col("event_id").cast("string").alias("key"), F.to_json(F.struct("event_id")).alias("value")), path)
    return kv.scan(spark, path, "100", "300").select("key")


@query("SELECT page_id, 'C' || (page_id % 50) || '-' || substr(url, length(url) - 24, 5) || '-' || substr(url, length(url) - 10, 3) AS id FROM pages WHERE length(url) >= 25")
def contour_id(spark, d):
    return read(spark, d, "pages").filter(F.length("url") >= 25).select("page_id", scalar.contour_id(F.col("page_id") % 50, F.col("url")).alias("id"))


@query("SELECT page_id, split_part(url, '/', -1) AS name FROM pages")
def basename(spark, d):
    return read(spark, d, "pages").select("page_id", scalar.basename(F.col("url")).alias("name"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%m') AS month, lpad(CAST(dayofyear(o_orderdate) AS VARCHAR), 3, '0') AS day FROM orders")
def doy_to_month(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.dayofyear("o_orderdate").alias("n"))
    return o.select("o_orderkey", scalar.month(scalar.day_of_year(F.col("y"), F.col("n"))).alias("month"), scalar.padded_day(F.col("n")).alias("day"))


@query("SELECT event_id, printf('%.4f', value) AS score, CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) AS whole, (['red', 'green', 'blue'])[CAST(event_id % 3 AS INTEGER) + 1] AS color FROM events WHERE value IS NOT NULL")
def score_format(spark, d):
    e = read(spark, d, "events").filter("value is not null")
    return e.select("event_id", scalar.score_text(F.col("value")).alias("score"), scalar.whole_text(F.col("value")).alias("whole"), scalar.color(("red", "green", "blue"), F.col("event_id")).alias("color"))


@query("SELECT count(DISTINCT text) AS contents, count(*) AS documents FROM documents")
def spectra_dedupe(spark, d):
    t = read(spark, d, "documents").groupBy(F.sha2("text", 224).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return t.agg(F.count(F.when(F.col("h").isNotNull(), 1)).alias("contents"), F.sum("n").alias("documents"))


@query("SELECT event_id FROM events WHERE (value > 50 AND event_type ILIKE 'c%') OR NOT (user_id BETWEEN 10 AND 60) AND value IS NOT NULL")
def cql_filter(spark, d):
    f = cql.parse("(value > 50 AND event_type LIKE 'c*') OR (NOT (user_id BETWEEN 10 AND 60) AND NOT (value IS NULL))")
    return read(spark, d, "events").filter(cql.column(f)).select("event_id")


@query("SELECT p_partkey FROM part WHERE p_size BETWEEN 5 AND 25 AND p_retailprice BETWEEN 900 AND 1300")
def bbox_filter(spark, d):
    return read(spark, d, "part").filter(cql.column(cql.parse("BBOX(geom, 5, 900, 25, 1300)"), "p_size", "p_retailprice")).select("p_partkey")


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_retailprice > 1000 THEN 'dear' WHEN p_size > 20 THEN 'middle' ELSE 'plain' END AS symbol FROM part")
def style_rules(spark, d):
    rules = [(cql.parse("p_size > 20"), "middle", False), (cql.parse("p_retailprice > 1000"), "dear", False), (cql.parse("p_size > 40"), "large", False), (None, "plain", True)]
    return read(spark, d, "part").select("p_partkey", cql.styled(rules, None).alias("symbol"))


@query("SELECT s_suppkey FROM (SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier) WHERE n BETWEEN 3 AND 4")
def feature_paging(spark, d):
    n = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    return read(spark, d, "supplier").withColumn("n", n).filter(cql.page(F.col("n"), 2, 1)).select("s_suppkey")


@query(f"""WITH {LL} SELECT vec_id, round(radians(lng) * 6378137.0, 3) AS x, round(ln(tan(radians(lat + 90) / 2)) * 6378137.0, 3) AS y,
    round(2 * 6378.137 * atan2(sqrt(pow(sin(radians(50 - lat) / 2), 2) + pow(sin(radians(10 - lng) / 2), 2) * cos(radians(lat)) * cos(radians(50))), sqrt(1 - (pow(sin(radians(50 - lat) / 2), 2) + pow(sin(radians(10 - lng) / 2), 2) * cos(radians(lat)) * cos(radians(50))))), 6) AS km FROM ll""")
def mercator_haversine(spark, d):
    x, y = geo.mercator(F.col("lng"), F.col("lat"))
    return located(spark, d).select("vec_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), r6(geo.haversine_km(F.col("lng"), F.col("lat"), F.lit(10.0), F.lit(50.0))).alias("km"))


@query(f"WITH {TALL}, {MEANS}, s AS (SELECT *, sum(m) OVER w AS sm, sum(m*m) OVER w AS q, count(*) OVER w AS n FROM m WINDOW w AS (PARTITION BY image_key)), z AS (SELECT image_key, band, sqrt(greatest(q/n - pow(sm/n, 2), 0.0)) AS sd, sqrt(greatest((q - m*m)/(n-1) - pow((sm-m)/(n-1), 2), 0.0)) AS wo FROM s) SELECT image_key AS key, CAST(band AS INTEGER) AS band, round(abs(sd - wo)/sd, 6) AS change FROM z WHERE abs(sd - wo)/sd > 0.02")
def rogue_bands(spark, d):
    m = tall(pixels(spark, d)).groupBy(F.col("image_key").alias("key"), "band").agg(F.avg("value").alias("loading")).withColumn("component", F.lit(1))
    return rounded(linalg.rogue_bands(m, (0.02,)).select("key", "band", "change"))


@query("WITH i AS (SELECT DISTINCT n_regionkey AS region_key, s_suppkey AS image_key, unnest(['B' || (s_suppkey % 3), 'B1', 'B2', 'B' || (s_suppkey % 2 + 4)]) AS band FROM supplier JOIN nation ON s_nationkey = n_nationkey), c AS (SELECT region_key, count(DISTINCT image_key) AS images FROM i GROUP BY 1), k AS (SELECT region_key, band FROM i JOIN c USING (region_key) GROUP BY region_key, band, images HAVING count(DISTINCT image_key) = images) SELECT region_key, string_agg(band, ',' ORDER BY band) AS bands FROM k GROUP BY 1")
def band_alignment(spark, d):
    s = read(spark, d, "supplier").join(read(spark, d, "nation"), F.expr("s_nationkey = n_nationkey"))
    k = F.col("s_suppkey")
    names = F.array(F.concat(F.lit("B"), k % 3), F.lit("B1"), F.lit("B2"), F.concat(F.lit("B"), k % 2 + 4))
    return linalg.aligned(s.select(F.col("n_regionkey").alias("region_key"), k.alias("image_key"), names.alias("band_names"))).select("region_key", F.array_join("bands", ",").alias("bands"))


# ---- not expressible in SQL: rows only here, NumPy in the tests


def model(spark, d):
    return linalg.pca(linalg.covariance(pixels(spark, d), "image_key"))


@query()
def pca_components(spark, d):
    return rounded(model(spark, d).select("key", "component", "eigenvalue"))


@query()
def explained_variance(spark, d):
    return rounded(linalg.explained(model(spark, d)))


@query()
def kmeans_full(spark, d):
    return cluster.kmeans_images(pixels(spark, d), 5, 5).select("image_key", "vec_id", "cluster")


def cluster_positions(spark, d):
    k = cluster.kmeans_images(pixels(spark, d), 3, 5).join(pixels(spark, d).select("vec_id", "y", "x"), "vec_id")
    n = k.groupBy("image_key", "cluster", F.floor(F.col("x") / 5).cast("int").alias("ix"), F.floor(F.least(F.col("y"), F.lit(19)) / 5).cast("int").alias("iy")).agg(F.count(F.lit(1)).alias("n"))
    return k, n


@query()
def contours(spark, d):
    c = contour.contours(cluster_positions(spark, d)[1], 5, 4, 25, 20)
    return c.select("image_key", "cluster", "level", F.size("polygon").alias("vertices"), r6(F.abs(geo.area(F.col("polygon")))).alias("area"), r6(geo.perimeter(F.col("polygon"))).alias("perimeter"))


@query()
def contour_scores(spark, d):
    k, n = cluster_positions(spark, d)
    c = contour.contours(n, 5, 4, 25, 20).filter("level = 'p95'").withColumn("contour_id", F.xxhash64("polygon"))
    return rounded(contour.contour_scores(c.select("image_key", "cluster", "contour_id", "polygon"), k.select("image_key", "cluster", "vec_id", "y", "x", "dist2")))


@query()
def connected_components(spark, d):
    p = pixels(spark, d).filter(F.element_at("spectrum", 1) > 0).select(F.lit(0).alias("image_key"), F.lit(0).alias("cluster"), "y", "x")
    return cluster.regions(p, lower=2)


@query()
def feature_clusters(spark, d):
    return geo.cluster_features(read(spark, d, "part").select((F.col("p_partkey") % 20).alias("layer"), F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 50).alias("y")), 5.0, 2)


@query()
def band_png_roundtrip(spark, d):
    """Pixels and sum of each image's first band after encoding as PNG and decoding."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        v = p.sort_values("vec_id")["v"].to_numpy()
        return pd.DataFrame({"image_key": [p["image_key"].iloc[0]], "png": [codecs.png_encode(v[None])]})

    v = pixels(spark, d).select("image_key", "vec_id", F.floor((F.element_at("spectrum", 1) + 10) * 1000).alias("v"))
    s = v.groupBy("image_key").applyInPandas(run, "image_key int, png binary").select("image_key", codecs.decode_column("png")("png").alias("r"))
    return s.select("image_key", F.size("r.samples").alias("pixels"), F.aggregate("r.samples", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


SQL["band_png_roundtrip"] = f"WITH {PX} SELECT image_key, CAST(count(*) AS INTEGER) AS pixels, CAST(sum(floor((s[1] + 10) * 1000)) AS BIGINT) AS total FROM px GROUP BY 1"


@query(f"WITH {PX} SELECT vec_id, 'POINT(' || vec_id % 25 || ' ' || vec_id // 25 || ')' AS t, CAST(vec_id % 25 AS DOUBLE) AS x, CAST(vec_id // 25 AS DOUBLE) AS y FROM px")
def wkt_points(spark, d):
    p = pixels(spark, d).select("vec_id", F.concat(F.lit("POINT("), "x", F.lit(" "), "y", F.lit(")")).alias("t"))
    g = features.wkt(F.col("t"))["rings"][0][0]
    return p.select("vec_id", "t", g["x"].alias("x"), g["y"].alias("y"))


@query("SELECT event_type AS key, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE json_valid(props) GROUP BY 1")
def stream_ingest(spark, d):
    """Events read as a stream through ingest; its catalog output summed as a batch would be."""
    base = shared_folder(spark, "stream")
    events = read(spark, d, "events")
    s = spark.readStream.schema(events.schema).option("pathGlobFilter", "events*.parquet").parquet(d)
    keys = s.filter(F.try_parse_json("props").isNotNull()).select(F.col("event_id").cast("string").alias("key"))

    def convert(todo):
        e = events.withColumn("key", F.col("event_id").cast("string"))
        return todo.join(e, "key").select("key", F.lit(True).alias("ok"), F.col("key").alias("file"), "event_type", "value")

    catalog = {"events": (f"{base}/out", lambda done: done.select("event_type", "value"))}
    ingest.ingest(keys, f"{base}/status", convert, f"{base}/ck", outputs=catalog).awaitTermination()
    return spark.read.schema("event_type string, value double").parquet(f"{base}/out").groupBy(F.col("event_type").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
