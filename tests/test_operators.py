"""Raster, statistics, linear algebra, clustering, contours, geometry, codecs, filters, ingest on hand-made data."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandloom import catalog, catalog_runs  # noqa: F401  (registers queries)
from bandloom.functions import scalar
from bandloom.operators import cluster, contour, geo, linalg, raster, stats
from bandloom.plans import cql, reports
from bandloom.sources import codecs, features, kv
from bandloom.streaming import ingest

SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]


def mask(spark, holes, h=7, w=7):
    return spark.createDataFrame([(0, y, x, (y, x) not in holes) for y in range(h) for x in range(w)], "image_key int, y int, x int, in_mask boolean")


def test_erosion(spark):
    left = lambda *a, **k: {(r["y"], r["x"]) for r in raster.erode(*a, **k).collect()}
    everything = {(y, x) for y in range(7) for x in range(7)}
    assert everything - left(mask(spark, {(3, 3)}), 7, 7) == {(y, x) for y, x in everything if abs(y - 3) + abs(x - 3) <= 2}
    assert (0, 6) in left(mask(spark, {(0, 0)}), 7, 7) and (0, 6) not in left(mask(spark, {(0, 0)}), 7, 7, wrap=True)
    smaller = left(mask(spark, {(0, 0), (5, 2)}), 7, 7)
    assert smaller <= left(mask(spark, {(0, 0)}), 7, 7)


def test_erosion_wraps_rows_beyond_the_height(spark):
    for h, holes in ((5, {(1, 2), (6, 0), (13, 5)}), (4, {(9, 1)}), (20, {(0, 0), (13, 6)}), (14, {(0, 0), (7, 3)})):
        apart = lambda a, b, n: min(abs(a - b), n - abs(a - b))
        want = {(y, x) for y in range(14) for x in range(7) if all(apart(y, v, h) + apart(x, u, 7) > 2 for v, u in holes)}
        assert {(r["y"], r["x"]) for r in raster.erode(mask(spark, holes, 14), h, 7, wrap=True).collect()} == want


def image(spark, rows):
    return spark.createDataFrame([(0, i, y, x, s) for i, (y, x, s) in enumerate(rows)], "image_key int, vec_id long, y int, x int, spectrum array<double>")


def test_flat_lines_and_bands(spark):
    rng = np.random.default_rng(0)
    rows = [(y, x, [float(rng.normal()), 1.0 if y == 2 else float(rng.normal()), 0.0]) for y in range(4) for x in range(5)]
    two = image(spark, [(y, x, s[:2]) for y, x, s in rows])
    assert {r["y"] for r in raster.fix_mask(two).collect()} == {0, 1, 3}
    assert {r["band"] for r in raster.usable_bands(image(spark, rows)).collect()} == {1, 2}


def test_corners_of_nothing(spark):
    r = raster.corners(mask(spark, {(y, x) for y in range(7) for x in range(7)})).first()
    assert r["left_x"] == r["bottom_y"] == -1


def test_rgb_bands():
    assert raster.rgb_bands([10, 20, 30], [15, 15, 15]) == [10, 20, 30] and raster.rgb_bands([1, 2], [5, 5, 5]) == [2, 1, 2]


def test_stretch_rounds_as_the_c_library(spark):
    """Over 2,000 images of two pixels: the greatest value is 255 or 254 by the last bit of its exp."""
    v = [[math.sin(i * 7 + j) for j in range(6)] for i in range(2000)]
    p = spark.createDataFrame([(i, 2 * i + k, x[3 * k : 3 * k + 3]) for i, x in enumerate(v) for k in (0, 1)], "image_key int, vec_id long, spectrum array<double>")
    want = {}
    for i, x in enumerate(v):
        e = [math.exp(u) for u in x]
        lo, hi = min(e), max(e)
        want |= {2 * i + k: [math.floor(255 * (u - lo) / (hi - lo)) for u in e[3 * k : 3 * k + 3]] for k in (0, 1)}
    assert {r["vec_id"]: [r["r"], r["g"], r["b"]] for r in raster.rgb_stretch(p, (1, 2, 3)).collect()} == want
    odd = spark.createDataFrame([(None,), (float("nan"),), (800.0,), (-800.0,)], "v double").select(scalar.libm_exp(F.col("v")).alias("e")).collect()
    assert odd[0]["e"] is None and math.isnan(odd[1]["e"]) and odd[2]["e"] == math.inf and odd[3]["e"] == 0


def test_normalize(spark):
    m = 500e-9
    solar = 2.5e-28 / (math.exp(0.0143878 / m / 5778) - 1) / m**5
    got = spark.range(1).select(raster.normalize(F.lit(3.0), F.lit(0.025), F.lit(500.0))).first()[0]
    assert got == pytest.approx(math.log(3 * 0.025 / solar + 1e-6))


def test_covariance_pca_projection(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    p = image(spark, [(i, 0, r.tolist()) for i, r in enumerate(a)])
    cov = {(r["band_a"], r["band_b"]): r["cov"] for r in linalg.covariance(p, "image_key").collect()}
    assert np.allclose([[cov[i, j] for j in range(1, 5)] for i in range(1, 5)], np.cov(a.T))
    model = linalg.pca(linalg.covariance(p, "image_key")).orderBy("component").collect()
    basis = [r["loadings"] for r in model]
    out = np.array([r[0] for r in p.select(linalg.project(F.col("spectrum"), F.array(*map(F.lit, a.mean(0).tolist())), basis)).collect()])
    assert np.allclose(out.var(0, ddof=1), [r["eigenvalue"] for r in model])
    values, rows = linalg.components(np.cov(a.T), np.eye(4))
    assert (np.diff(values) >= 0).all() and rows.shape == (4, 4)


def test_rogue_bands(spark):
    v = [1.0, 2.0, 3.0, 50.0]
    got = {r["band"]: r["change"] for r in linalg.rogue_bands(spark.createDataFrame([(0, 1, i, x) for i, x in enumerate(v)], "key int, component int, band int, loading double"), (0.0,)).collect()}
    for i, x in enumerate(v):
        rest = v[:i] + v[i + 1 :]
        assert got[i] == pytest.approx(abs(np.std(v) - np.std(rest)) / np.std(v))


def test_histogram_and_similarity(spark):
    v = spark.createDataFrame([("a", float(i)) for i in range(11)] + [("b", float(i * i)) for i in range(11)], "k string, v double")
    h = {(r["k"], r["bin"]): r["n"] for r in stats.histogram(v, "k", "v", 10).collect()}
    assert [h["a", i] for i in range(10)] == np.histogram(range(11), 10)[0].tolist() and sum(h["b", i] for i in range(10)) == 11
    s = stats.similarity(spark.createDataFrame([("a", 0, 3), ("a", 1, 0), ("b", 0, 1), ("b", 1, 0)], "k string, bin int, n long"), "k").first()
    assert s["chi2"] == pytest.approx(0.5 * 4 / 4)


def test_normalized_scores(spark):
    q = spark.createDataFrame([(0, 1.0), (500, 2.0), (1000, 4.0)], "quantile int, score double")
    got = stats.normalized(spark.createDataFrame([(x,) for x in (0.5, 1.5, 3.0, 4.0, 9.0)], "s double"), "s", q).orderBy("s").collect()
    assert [r["norm"] for r in got] == [0.0, 250.0, 750.0, 1000.0, 1000.0]


def test_kmeans():
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.normal(c, 0.1, (50, 2)) for c in (0, 5, 10)])
    centers, labels = cluster.kmeans(data, 3, 1)
    assert sorted(centers[:, 0].round()) == [0, 5, 10] and len(set(labels[:50])) == 1
    c1, _ = cluster.lloyd(data, data[:3], 1)
    c5, _ = cluster.lloyd(data, data[:3], 5)
    assert cluster.cluster_quality(data, c5) <= cluster.cluster_quality(data, c1)
    empty, _ = cluster.lloyd(data, np.array([[0.0, 0.0], [99.0, 99.0]]), 3)
    assert empty[1].tolist() == [99.0, 99.0]


def test_regions():
    g = np.array([[1, 0, 0, 1], [0, 1, 0, 0], [0, 0, 0, 1]], bool)
    assert cluster.label_regions(g).tolist() == [[1, 0, 0, 2], [0, 1, 0, 0], [0, 0, 0, 3]]


def test_contours():
    e = np.arange(6.0)
    area = lambda p: 0.5 * sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1], strict=True))
    one = np.zeros((5, 5))
    one[2, 2] = 1
    (p,) = contour.trace(one, 0.5, e, e)
    assert len(p) == 4 and abs(area(p)) == pytest.approx(0.5)
    (edge,) = contour.trace(np.eye(5)[:, :1] * np.ones((1, 5)), 0.5, e, e)
    assert len(edge) >= 3
    ring = np.ones((5, 5))
    ring[2, 2] = 0
    assert len(contour.trace(ring, 0.5, e, e)) == 2
    saddle = np.zeros((5, 5))
    saddle[1, 1] = saddle[2, 2] = 1
    assert contour.trace(saddle, 0.5, e, e) and contour.trace(np.zeros((5, 5)), 0.5, e, e) == []
    assert len(contour.smooth(p)) == 20
    circle = [(math.cos(t), math.sin(t)) for t in np.linspace(0, 2 * math.pi, 40, endpoint=False)]
    assert abs(area(contour.smooth(circle))) == pytest.approx(math.pi, rel=0.05)


def polygon(spark, points):
    return spark.createDataFrame([([{"x": x, "y": y} for x, y in points],)], "p array<struct<x: double, y: double>>")


def test_polygons(spark):
    d = polygon(spark, SQUARE)
    r = d.select(geo.area(F.col("p")).alias("a"), geo.perimeter(F.col("p")).alias("l"), geo.centroid(F.col("p")).alias("c"), geo.bounds(F.col("p")).alias("b"), geo.contains(F.col("p"), F.lit(1.0), F.lit(1.0)).alias("in"), geo.contains(F.col("p"), F.lit(2.0), F.lit(1.0)).alias("on"), geo.contains(F.col("p"), F.lit(3.0), F.lit(1.0)).alias("out")).first()
    assert (r["a"], r["l"], tuple(r["c"]), tuple(r["b"]), r["in"], r["on"], r["out"]) == (4.0, 8.0, (1.0, 1.0), (0.0, 0.0, 2.0, 2.0), True, True, False)
    back = polygon(spark, SQUARE[::-1]).select(geo.area(F.col("p")), geo.area(geo.rotated(F.col("p"), 30, 1, 1)), geo.area(geo.resized(F.col("p"), 2, 0, 0))).first()
    assert back[0] == -4 and back[1] == pytest.approx(-4) and back[2] == -16
    flat = polygon(spark, [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]).select(geo.centroid(F.col("p"))).first()[0]
    assert flat["x"] is None
    six = spark.range(1).select(geo.area(geo.regular_polygon(F.lit(0.0), F.lit(0.0), F.lit(1.0), 6))).first()[0]
    assert abs(six) == pytest.approx(3 * math.sqrt(3) / 2)


def test_geodesy(spark):
    import pandas as pd

    one = lambda v: pd.Series([v])
    assert geo.vincenty_km(one(0.0), one(0.0), one(1.0), one(0.0))[0] == pytest.approx(111.319, abs=1e-3)
    assert geo.vincenty_km(one(3.0), one(4.0), one(3.0), one(4.0))[0] == 0
    x, y = geo.mercator(F.lit(10.0), F.lit(50.0))
    lng, lat = geo.unmercator(x, y)
    r = spark.range(1).select(lng, lat, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)), geo.heading(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(10.0))).first()
    assert r[0] == pytest.approx(10) and r[1] == pytest.approx(50) and r[2] == pytest.approx(math.pi * 6378.137 / 2) and r[3] == 0
    assert geo.segments_intersect((0, 0, 2, 2), (0, 2, 2, 0)) == (1, 1) and geo.segments_intersect((0, 0, 1, 1), (0, 1, 1, 2)) is None
    assert geo.point_segment_distance(1, 1, (0, 0, 2, 0)) == 1
    assert geo.simplify([(0, 0), (1, 0.01), (2, 0), (3, 5)], 0.1) == [(0, 0), (2, 0), (3, 5)]


def test_codecs(spark, tmp_path):
    a = np.arange(12).reshape(3, 4) * 6000 - 5
    assert (codecs.png_decode(codecs.png_encode(a)) == np.clip(a, 0, 65535)).all()
    assert (codecs.png_decode(codecs.png_encode(a, 8)) == np.clip(a, 0, 255)).all()
    assert (codecs.tiff_decode(codecs.tiff_encode(a)) == np.clip(a, 0, 65535)).all()
    bad = bytearray(codecs.png_encode(a))
    bad[-20] ^= 1
    with pytest.raises(ValueError):
        codecs.png_decode(bytes(bad))
    meta = codecs.metadata('GROUP = A\n X = 1\n Y = "text"\n GROUP = B\n  Z = 2.5\n END_GROUP = B\nEND_GROUP = A\nW = up\nEND')
    assert meta == {"A": {"X": 1, "Y": "text", "B": {"Z": 2.5}}, "W": "up"}
    assert json.loads(spark.range(1).select(codecs.metadata_json(F.lit("A = 1"))).first()[0]) == {"A": 1}
    assert codecs.open_envelope(codecs.envelope(codecs.JSON_CODE, b'{"a": 1}')) == {"a": 1}
    (tmp_path / "img").mkdir()
    (tmp_path / "img/EO1_B010_L1T.TIF").write_bytes(codecs.tiff_encode(a))
    (tmp_path / "img/EO1_B011_L1T.TIF").write_bytes(b"junk")
    got = {r["band"]: r for r in codecs.read_bands(spark, str(tmp_path)).collect()}
    assert got["B010"]["width"] == 4 and got["B010"]["samples"] == np.clip(a, 0, 65535).ravel().tolist() and got["B011"]["samples"] is None


def test_features(spark):
    text = json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": "a", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 0]]]}}, {"type": "Feature", "id": "b", "properties": {}, "geometry": {"type": "Point", "coordinates": [3, 4]}}]})
    f = spark.createDataFrame([(text,)], "t string").select(features.geojson(F.col("t")).alias("f")).first()["f"]
    assert f[0]["rings"][0][1]["x"] == 2 and f[1]["rings"][0][0]["y"] == 4 and f[0]["properties"] == {"n": "1"}
    w = spark.createDataFrame([("POLYGON((0 0,1 0,1 1),(0 0,2 2,3 3))",), ("LINESTRING(1 2, 3 4)",), ("POINT(a b)",)], "t string").select(features.wkt(F.col("t")).alias("w")).collect()
    assert len(w[0]["w"]["rings"]) == 2 and w[1]["w"]["rings"][0][1]["y"] == 4 and w[2]["w"]["rings"] is None
    pts = [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]
    assert features.encode_polyline(pts) == "_p~iF~ps|U_ulLnnqC_mqNvxq`@" and np.allclose(features.decode_polyline(features.encode_polyline(pts)), pts)
    d = polygon(spark, SQUARE).select(features.to_wkt(F.col("p")), features.to_geojson(F.lit(1), F.col("p"))).first()
    assert d[0].startswith("POLYGON((0.0 0.0,") and json.loads(d[1])["geometry"]["coordinates"][0][0] == [0, 0]


def test_cql(spark):
    d = spark.createDataFrame([(1, "Abc", 5.0, 5.0), (2, None, 15.0, 5.0), (3, "x.z", 1.0, 1.0)], "id int, name string, x double, y double")
    ids = lambda t: [r["id"] for r in d.filter(cql.column(cql.parse(t))).orderBy("id").collect()]
    assert ids("name LIKE 'a*'") == [1] and ids("name LIKE 'x!.z'") == [3] and ids("name LIKE 'x!.y'") == []
    assert ids("name IS NULL OR id = 1 AND id = 2") == [2]  # one precedence, from the left
    assert ids("BBOX(g, 0, 0, 10, 10)") == [1, 3] and ids("INTERSECTS(g, POLYGON((0 0, 10 0, 10 10, 0 10, 0 0)))") == [1, 3]
    assert ids("NOT (id BETWEEN 2 AND 3)") == [1] and ids("id IN (1, 3) AND name <> 'it''s'") == [1, 3]
    for t in ("a = 1 AND (b LIKE 'x*' OR NOT c IS NULL)", "BBOX(g,1,2,3,4)", "a BETWEEN 1 AND 2"):
        assert cql.parse(cql.write(cql.parse(t))) == cql.parse(t)
    for t in ("a =", "a = 1 b", "= 1", "a ~ 1"):
        with pytest.raises(ValueError):
            cql.parse(t)


def test_kv_and_reports(spark, tmp_path):
    path = str(tmp_path / "kv")
    rows = lambda *r: spark.createDataFrame(r, kv.SCHEMA)
    kv.put(rows(("a", "1"), ("b", "{}")), path, 1)
    kv.put(rows(("a", "2")), path, 2)
    assert {r["key"]: r["value"] for r in kv.scan(spark, path, "a", "b").collect()} == {"a": "2", "b": "{}"}
    with pytest.raises(Exception, match="not JSON"):
        kv.put(rows(("c", "{")), path, 3)
    c = spark.createDataFrame([("d", 5, 2.0, [[1.0, 1.0], [3.0, 3.0]])], "directory string, acquisition_start long, radiance double, corners array<array<double>>")
    assert reports.catalog_filter(c, (0, 5), (0, 9), 2.0, 2.0, 0.1).count() == 1 and reports.catalog_filter(c, (0, 5), (0, 9), 9.0, 9.0, 1.0).count() == 0
    assert reports.catalog_filter(c, (0, 5), (0, 9), 9.0, 9.0, 0).count() == 1
    assert json.loads(reports.catalog_json(c).first()[0])["hyperion"][0]["directory"] == "d"
    assert "<td>1&amp;</td>" in reports.html_table("t", ["a"], [("1&",)])


def test_scalars(spark):
    r = spark.range(1).select(scalar.day_of_year(F.lit(2020), F.lit(366)).cast("string"), scalar.start_time(F.lit("2013 300 02:15:04")).cast("string"), scalar.start_time(F.lit("bad")), scalar.region_key(F.lit(None).cast("string"), F.array(F.lit("b" * 30), F.lit("a" * 30)))).first()
    assert tuple(r) == ("2020-12-31", "2013-10-27 02:15:04", None, "a" * 22)


def test_ingest(spark, tmp_path):
    fails = lambda todo: todo.select("key", (F.col("key") != "bad").alias("ok"), F.lit("f").alias("file"))
    status = spark.createDataFrame([], ingest.STATUS)
    keys = spark.createDataFrame([("a",), ("bad",)], "key string")
    for n in range(6):
        status = spark.createDataFrame(ingest.advance(status, keys, fails).collect(), ingest.STATUS)
        assert {r["key"]: r["attempts"] for r in status.collect()} == {"a": 1, "bad": min(n + 1, 4)}
    src = tmp_path / "in"
    keys.write.parquet(str(src))
    out = []
    for i in range(2):  # a second run finds no new file
        s = spark.readStream.schema("key string").parquet(str(src))
        q = ingest.ingest(s, str(tmp_path / "status"), fails, str(tmp_path / f"ck{i}"), lambda df: out.extend(r["key"] for r in df.collect()))
        q.awaitTermination()
    assert out == ["a"] and {r["key"]: r["attempts"] for r in ingest.latest(spark, str(tmp_path / "status")).collect()} == {"a": 1, "bad": 2}


def test_queries_match_sql(spark):
    import duckdb

    d, c = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("nation", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages"):
        c.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    for name in ("gray_band_stats", "band_covariance", "roll_mask", "fix_mask", "kmeans_assign", "normalized_score", "polygon_centroid", "catalog_filter", "cql_filter", "band_alignment"):
        a, b = catalog.QUERIES[name](spark, d).toPandas(), c.sql(catalog.SQL[name]).df()
        cols = sorted(a.columns)
        assert cols == sorted(b.columns), name
        rows = lambda df, cols=cols: sorted(map(str, df[cols].astype(object).map(lambda v: round(float(v), 5) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else v).values.tolist()))
        assert rows(a) == rows(b), name
