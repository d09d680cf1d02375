"""Run reports, image models, records and formats, lines and polygons, streams, on hand-made data."""

import json
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bandloom import catalog, catalog_runs  # noqa: F401
from bandloom.functions import scalar
from bandloom.operators import cluster, contour, geo, linalg, raster, stats
from bandloom.plans import reports
from bandloom.sources import codecs, kv, markup, sequence
from bandloom.sources.tables import pixels
from bandloom.streaming import ingest

SF = "/root/testdata/sf0.001"
POINT = "struct<x: double, y: double>"


def line(*points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def of(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def spectra():
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    return np.array(t["vec_id"]), np.array(t["label"]), np.array(t["embedding"], float)


def test_models_over_all_bands(spark):
    _, label, s = spectra()
    cov = {}
    for r in linalg.covariance(pixels(spark, SF), "image_key").collect():
        cov.setdefault(r["key"], np.zeros((s.shape[1], s.shape[1])))[r["band_a"] - 1, r["band_b"] - 1] = r["cov"]
    assert set(cov) == set(label.tolist())
    for k, c in cov.items():
        assert np.allclose(c, np.cov(s[label == k].T), atol=1e-9)
    for r in linalg.pca(linalg.covariance(pixels(spark, SF), "image_key")).filter("component <= 3").collect():
        values, vectors = np.linalg.eigh(cov[r["key"]])
        assert r["eigenvalue"] == pytest.approx(values[-r["component"]])
        assert abs(vectors[:, -r["component"]] @ np.array(r["loadings"])) == pytest.approx(1)
    one = linalg.covariance(pixels(spark, SF).limit(1).withColumn("image_key", F.lit(9)), "image_key")
    assert one.filter("cov is not null and not isnan(cov)").count() == 0  # one pixel has no covariance


def test_partials_are_handed_on(spark, monkeypatch):
    whole = {(r["key"], r["band_a"], r["band_b"]): r["cov"] for r in linalg.covariance(pixels(spark, SF), "image_key").collect()}
    monkeypatch.setattr(linalg, "HELD", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        again = {(r["key"], r["band_a"], r["band_b"]): r["cov"] for r in linalg.covariance(pixels(spark, SF), "image_key").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert again == pytest.approx(whole)


def test_noise_adjusted_pca(spark):
    rng = np.random.default_rng(3)
    m, n = (a @ a.T + np.eye(4) for a in rng.normal(size=(2, 4, 6)))
    rows = lambda k, a: [(k, i + 1, j + 1, float(a[i, j])) for i in range(4) for j in range(4)]
    d = lambda r: spark.createDataFrame(r, "key int, band_a int, band_b int, cov double")
    got = linalg.noise_pca(d(rows(1, m) + rows(2, m)), d(rows(1, n))).orderBy("component").collect()
    assert {r["key"] for r in got} == {1}
    for r, value in zip(got, sorted(np.linalg.eigvals(np.linalg.inv(m) @ n).real), strict=True):
        v = np.array(r["loadings"])
        assert r["eigenvalue"] == pytest.approx(value) and np.allclose(np.linalg.inv(m) @ n @ v, value * v)


def test_outlier_image(spark):
    d = spark.createDataFrame([(1, 2, 0.5, 2.0), (1, 3, 0.9, 1.0), (2, 1, 0.5, 2.0), (2, 3, -0.9, 1.0), (3, 1, 0.9, 1.0), (3, 2, -0.9, 1.0)], "a int, b int, correlation double, chi2 double")
    assert stats.outlier_image(d).first()["outlier"] == 1
    assert stats.outlier_image(d.withColumn("correlation", F.lit(-1.0))).first()["outlier"] is None
    assert stats.outlier_image(d.withColumn("chi2", F.when(F.col("a") == 2, 0.0).otherwise(F.col("chi2"))).withColumn("correlation", F.abs("correlation"))).first()["outlier"] == 2


def test_anomalous_clusters(spark):
    d = spark.createDataFrame([(0, 1, 0, 0, 5, 3.0), (0, 2, 0, 1, 5, 1.0), (0, 3, 1, 1, 5, 1.0), (0, 4, 2, 2, 6, 0.5)], "image_key int, vec_id long, y int, x int, cluster int, dist2 double")
    got = cluster.anomalous_clusters(d, d.filter("vec_id = 1")).collect()
    assert [tuple(r) for r in got] == [(0, 5, 3, 0, 1)]
    assert cluster.anomalous_clusters(d, d.limit(0)).count() == 0


def test_nearest_center_in_blocks():
    rng = np.random.default_rng(0)
    data, centers = rng.normal(size=(100, 3)), rng.normal(size=(7, 3))
    d = ((data[:, None] - centers[None]) ** 2).sum(2)
    labels, least = cluster.nearest_center(data, centers, 9)
    assert (labels == d.argmin(1)).all() and np.allclose(least, d.min(1))


def test_contour_records_and_scores(spark):
    flat = {k: float(k[1] == "r") * 0.2 - float(k[1] == "l") * 0.2 for k in ("tl", "tm", "tr", "ml", "mm", "mr", "bl", "bm", "br")}
    up = {k: 50 + float(k[0] == "t") * 0.2 - float(k[0] == "b") * 0.2 for k in flat}
    square = [(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0)]
    c = spark.createDataFrame([(0, 1, 7, [{"x": x, "y": y} for x, y in square])], f"image_key int, cluster int, contour_id long, polygon array<{POINT}>")
    r = contour.records(c, 10.0, 8.0, flat, up).first()
    east, north = of(spark, *geo.meters(F.lit(0.04), F.lit(50.05), F.lit(0.0), F.lit(50.0)))
    assert r["area_pixels"] == 16 and r["area_m2"] == pytest.approx(16 * east * north) and r["perimeter_m"] == pytest.approx(8 * (east + north))
    assert (r["lng"], r["lat"]) == (pytest.approx(-0.04), pytest.approx(50.0))
    p = [(0, 1, i, int(y), int(x), float(i)) for i, (x, y) in enumerate(square)] + [(0, 1, 9, 0, 0, 100.0)]
    px = spark.createDataFrame(p, "image_key int, cluster int, vec_id long, y int, x int, dist2 double")
    centers = spark.createDataFrame([(0, 1, 2.5)], "image_key int, cluster int, mahalanobis double")
    score = contour.score_pairs(c, px, centers).first()
    assert score["cluster_score"] == 2.5 and score["contour_score"] == pytest.approx(np.mean(np.sqrt(range(4))))
    score = contour.score_pairs(c, px.filter("vec_id > 0"), centers).first()  # a vertex is no pixel: the nearest count
    near = contour.contour_scores(c, px.filter("vec_id > 0")).first()["score"]
    assert score["contour_score"] == pytest.approx(near)


def test_lines_and_polygons(spark):
    ring, hole = line((0, 0), (4, 0), (4, 4), (0, 4)), line((1, 1), (2, 1), (2, 2), (1, 2))
    rings = F.array(ring, hole)
    assert of(spark, geo.area_with_holes(rings), geo.length(ring), geo.length(geo.closed(ring)), geo.length(line((1, 1)))) == (15.0, 12.0, 16.0, 0.0)
    inside = lambda x, y: geo.contains_with_holes(rings, F.lit(float(x)), F.lit(float(y)))
    assert of(spark, inside(3, 3), inside(1.5, 1.5), inside(5, 5)) == (True, False, False)
    away = lambda x, y: geo.polygon_distance(rings, F.lit(float(x)), F.lit(float(y)))
    assert of(spark, away(3, 3), away(7, 8), away(1.5, 1.6)) == (0.0, 5.0, pytest.approx(0.4))
    far = line((9, 9), (10, 9), (10, 10))
    assert of(spark, geo.rings_intersect(ring, hole), geo.rings_intersect(ring, far), geo.rings_intersect(ring, line((3, 3), (6, 3), (6, 6)))) == (True, False, True)
    assert [tuple(p) for p in of(spark, geo.crossings(line((0, 0), (4, 4)), line((0, 4), (4, 0))))[0]] == [(2.0, 2.0)]
    assert geo.split_line([(0, 0), (4, 0)], [(1, -1), (1, 1), (3, 1), (3, -1)]) == [[(0, 0), (1.0, 0.0)], [(1.0, 0.0), (3.0, 0.0)], [(3.0, 0.0), (4, 0)]]
    assert geo.split_line([(0, 0), (4, 0)], [(0, 1), (4, 1)]) == [[(0, 0), (4, 0)]]
    c = of(spark, geo.collection(F.array(ring, hole)))[0]
    assert (c["length"], c["area"], c["left"], c["top"]) == (20.0, 17.0, 0.0, 4.0) and c["x"] == pytest.approx((2 * 16 + 1.5) / 17)


def test_destination_is_at_its_distance(spark):
    for bearing in (0.0, 77.0, 200.0):
        there = geo.destinations(F.lit(10.0), F.lit(50.0), F.lit(bearing), F.lit(123456.0))
        km, lat = of(spark, geo.vincenty(F.lit(10.0), F.lit(50.0), there["lng"], there["lat"]), there["lat"])
        assert km == pytest.approx(123.456, abs=2e-6) and (lat > 50) == (math.cos(math.radians(bearing)) > 0)


def test_markup_readers(spark):
    read = lambda text, form: [(r["id"], r["name"], r["kind"], [tuple(p) for p in r["points"]]) for r in of(spark, markup.read(F.lit(text), form))[0]]
    kml = '<kml xmlns="k"><Document><Placemark id="a"><name>n</name><MultiGeometry><Point><coordinates>1,2,3</coordinates></Point><LineString><coordinates>1,2 3,4</coordinates></LineString></MultiGeometry></Placemark></Document></kml>'
    assert read(kml, "kml") == [("a", "n", "Point", [(1.0, 2.0)]), ("a", "n", "LineString", [(1.0, 2.0), (3.0, 4.0)])]
    gpx = '<gpx><wpt lat="2" lon="1"><name>w</name></wpt><trk><name>t</name><trkseg><trkpt lat="1" lon="0"/><trkpt lat="3" lon="2"/></trkseg></trk></gpx>'
    assert read(gpx, "gpx") == [(None, "w", "Point", [(1.0, 2.0)]), (None, "t", "LineString", [(0.0, 1.0), (2.0, 3.0)])]
    osm = '<osm><node id="1" lat="0" lon="0"/><node id="2" lat="0" lon="1"/><node id="3" lat="1" lon="1"/><node id="4" lat="9" lon="9"><tag k="name" v="x"/></node><way id="w"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="1"/></way></osm>'
    assert [r[:3] for r in read(osm, "osm")] == [("w", None, "LinearRing"), ("4", "x", "Point")]
    gml = '<c xmlns:gml="g"><gml:featureMember><f fid="q"><gml:LineString><gml:coordinates>1,2 3,4</gml:coordinates></gml:LineString></f></gml:featureMember></c>'
    assert read(gml, "gml") == [("q", None, "LineString", [(1.0, 2.0), (3.0, 4.0)])]
    rss = '<rss xmlns:georss="g" xmlns:geo="w"><item><title>t</title><georss:line>1 2 3 4</georss:line></item><item><geo:lat>5</geo:lat><geo:long>6</geo:long></item></rss>'
    assert read(rss, "georss") == [(None, "t", "LineString", [(2.0, 1.0), (4.0, 3.0)]), (None, None, "Point", [(6.0, 5.0)])]
    assert of(spark, markup.read(F.lit("<broken"), "kml"), markup.read(F.lit(None).cast("string"), "kml")) == (None, None)
    for form in ("kml", "gml", "gpx", "georss", "atom"):
        assert read(of(spark, markup.write(F.lit("i"), F.lit("a<b"), line((1, 2), (3, 4)), form))[0], form)[0][1:] == ("a<b", "LineString", [(1.0, 2.0), (3.0, 4.0)])


def test_sequence_files(spark, tmp_path):
    raster_ = np.arange(6).reshape(2, 3)
    rows = [("img/1", codecs.envelope(codecs.PNG, codecs.png_encode(raster_))), ("meta/1", codecs.envelope(codecs.JSON_CODE, b'{"a": 1}')), ("raw/1", codecs.envelope(codecs.RAW, b"xyz")), ("bad/1", b"\x32\x00")]
    sequence.write(spark.createDataFrame([(k, bytearray(v)) for k, v in rows] + [(None, None)], "key string, value binary"), str(tmp_path / "s"))
    back = {r["key"]: r for r in sequence.read_images(spark, str(tmp_path / "s")).collect()}
    assert set(back) == {k for k, _ in rows}
    assert (back["img/1"]["height"], back["img/1"]["width"], back["img/1"]["samples"]) == (2, 3, raster_.ravel().tolist())
    assert json.loads(back["meta/1"]["text"]) == {"a": 1} and bytes(back["raw/1"]["raw"]) == b"xyz" and back["bad/1"]["samples"] is None
    assert [r["key"] for r in sequence.read(spark, str(tmp_path / "s"), "img/").collect()] == ["img/1"]


def test_rgba_image():
    a = np.arange(12).reshape(2, 2, 3)
    got = codecs.rgba_decode(codecs.rgba_image(a, np.array([[1, 0], [0.5, -1]])))
    assert (got[:, :, :3] == a[:, :, ::-1]).all() and got[:, :, 3].tolist() == [[255, 0], [255, 0]]
    with pytest.raises(ValueError):
        codecs.rgba_decode(codecs.png_encode(np.zeros((1, 1))))


def test_metadata_fields(spark):
    text = 'GROUP = L1T\nGROUP = L1_METADATA_FILE\nGROUP = PRODUCT_METADATA\nSTART_TIME = "2013 300 02:15:04"\nEND_TIME = "no"\nEND_GROUP = PRODUCT_METADATA\nGROUP = PRODUCT_PARAMETERS\nSUN_AZIMUTH = 12.5\nEND_GROUP = PRODUCT_PARAMETERS\nEND_GROUP = L1_METADATA_FILE\nEND_GROUP = L1T'
    d = spark.createDataFrame([(text,), (None,)], "t string").select(codecs.metadata_json(F.col("t")).alias("j"))
    j = F.col("j")
    got = d.select(scalar.acquisition_start(j).alias("a"), scalar.acquisition_end(j).alias("b"), scalar.sun_azimuth(j).alias("c"), scalar.sun_elevation(j).alias("d"), F.size(scalar.radiance_scaling(j)).alias("e")).collect()
    assert tuple(got[0]) == (1382840104000, None, 12.5, None, 0) and tuple(got[1]) == (None, None, None, None, 0)


def test_bands_and_curves(spark):
    p = spark.createDataFrame([(0, 0, 0, [1.0, 2.0]), (0, 0, 1, [3.0, 4.0])], "image_key int, y int, x int, spectrum array<double>")
    at = raster.spectrum_at(p, spark.createDataFrame([(0, 0, 1), (0, 9, 9)], "image_key int, y int, x int"))
    assert [tuple(r) for r in raster.spectrum_curve(at, F.col("band") * 10).orderBy("wavelength").collect()] == [(0, 0, 1, 10, 3.0), (0, 0, 1, 20, 4.0)]
    v = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "image_key int, v double")
    assert sorted((r["image_key"], r["v"]) for r in raster.scaled_bytes(v, "v").collect()) == [(0, 0), (0, 255), (1, 0)]
    svg = of(spark, reports.svg_overlay(4, 3, F.lit("QUJD"), F.array(reports.svg(4, 3, line((0, 0), (1, 1), (2, 0)), F.lit("red")), reports.svg_curve(line((0, 0), (1, 5)), 10.0, 20.0))))[0]
    assert svg.startswith("<svg") and "QUJD" in svg and 'd="M0.0,20.0 L10.0,0.0"' in svg


def test_key_value_ties_and_checks(spark, tmp_path):
    path = str(tmp_path / "kv")
    kv.put(spark.createDataFrame([("a", "1"), ("a", "3"), ("a", "2"), ("b", "9")], "key string, value string"), path, 1)
    assert {r["key"]: r["value"] for r in kv.scan(spark, path).collect()} == {"a": "3", "b": "9"}
    kv.put(spark.createDataFrame([("a", "0")], "key string, value string"), path, 2)
    assert {r["key"]: r["value"] for r in kv.scan(spark, path, "a", "a").collect()} == {"a": "0"}
    with pytest.raises(Exception, match="not JSON"):
        ingest.checked(spark.createDataFrame([("{",)], "value string")).collect()


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    src, ck = str(tmp_path / "in"), tmp_path / "ck"
    spark.createDataFrame([("a",), ("bad",)], "key string").write.parquet(src)
    fails = lambda todo: todo.select("key", (F.col("key") != "bad").alias("ok"), F.lit("f").alias("file"))
    outputs = {"names": (str(tmp_path / "names"), lambda done: done.select("file", "key"))}
    for i in range(3):
        s = spark.readStream.schema("key string").parquet(src)
        ingest.ingest(s, str(tmp_path / "status"), fails, str(ck), outputs=outputs).awaitTermination()
        ck.rename(tmp_path / f"lost{i}")  # as if the batch's commit had been lost
        assert {r["key"]: (r["attempts"], r["ok"]) for r in ingest.latest(spark, str(tmp_path / "status")).collect()} == {"a": (1, True), "bad": (1, False)}
        assert [r["key"] for r in spark.read.parquet(str(tmp_path / "names")).collect()] == ["a"]


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(4)
    at = [0.0, 0.013, 0.25, 0.5, 0.77, 0.99, 1.0]
    for v in (rng.normal(size=5000), np.repeat([3.0, 1.0, 2.0], [500, 3, 800]), np.exp(rng.normal(size=999) * 9), np.array([4.0]), np.array([2.0, 1.0])):
        got = stats.quantiles(spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double"), "v", at).first()["q"]
        assert np.allclose(got, np.percentile(v, [100 * p for p in at]))
    got = stats.quantiles(spark.createDataFrame([(float(x),) for x in v], "v double"), "v", [0.5, 1.0], 0.9).first()["q"]
    assert np.allclose(got, np.percentile(np.minimum(v, np.percentile(v, 90)), [50, 100]))
    assert stats.quantiles(spark.createDataFrame([], "v double"), "v", at).first()["q"] is None


def test_feature_clusters_by_cells_equal_a_search_of_all(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i % 2), i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-20, 20, (300, 2)))] + [(0, 900, None, 1.0)]
    got = {r["id"]: r["cluster"] for r in geo.cluster_features(spark.createDataFrame(rows, "layer long, id long, x double, y double"), 4.0, 2).collect()}
    want = {900: None}
    for layer in (0, 1):
        centers, of_ = [], {}
        for _, i, x, y in (r for r in rows if r[0] == layer and r[2] is not None):
            k = next((k for k, c in enumerate(centers) if math.hypot(c[0] - x, c[1] - y) <= 4.0), len(centers))
            if k == len(centers):
                centers.append((x, y))
            of_[i] = k
        want |= {i: k if list(of_.values()).count(k) >= 2 else None for i, k in of_.items()}
    assert got == want


@pytest.mark.parametrize("name", ["stream_statistics", "stream_status"])
def test_streams_read_tables_of_several_files(spark, tmp_path, name):
    for t in ("embeddings", "pages"):
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(3).write.parquet(str(tmp_path / f"{t}.parquet"))
    folder, file = (sorted(map(str, catalog.QUERIES[name](spark, d).collect())) for d in (str(tmp_path), SF))
    assert folder == file and folder


def test_overlay_rounds_as_its_sql(spark, tmp_path):
    """Two pixels an image, dark and bright; the last bit of exp decides whether the bright one is 254 or 255."""
    duckdb = pytest.importorskip("duckdb")
    ends = [(-0.18672092258930206, 0.3358409106731415), (-0.23972009122371674, 0.23767609894275665), (-0.28709545731544495, 0.24360030889511108), (-0.19667501747608185, 0.22411595284938812), (-0.2665800452232361, 0.21508647501468658), (-0.26225486397743225, 0.16903214156627655)]
    rows = [(2 * i + k, [0.5] * 9 + [v] * 21, i) for i, pair in enumerate(ends) for k, v in enumerate(pair)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    c = duckdb.connect()
    c.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = c.sql(f"select image_key, pixels, first, third, alpha from ({catalog.SQL['rgba_png']})").fetchall()
    assert sorted(map(tuple, catalog.QUERIES["rgba_png"](spark, str(tmp_path)).collect())) == sorted(want) and len(want) == len(ends)


def test_overlay_counts_every_row_as_its_sql(spark, tmp_path):
    """Repeated and null vec_ids, NaN or nothing in the mask's band, missing values, short and missing spectra."""
    duckdb = pytest.importorskip("duckdb")
    nan, full = float("nan"), lambda m, r, g, b: [m] * 9 + [r] * 10 + [g] * 10 + [b]
    images = {
        0: [(1, full(0.5, 0.1, 0.2, 0.3)), (1, full(-0.5, 0.4, 0.5, 0.6)), (2, full(0.5, 0.7, 0.8, 0.9))],
        1: [(None, full(0.5, 0.1, 0.2, 0.3)), (None, full(0.5, 0.4, 0.5, 0.6)), (1, full(0.5, 0.7, 0.8, 0.9))],
        2: [(3, full(nan, 0.1, 0.2, 0.3)), (4, full(None, 0.4, 0.5, 0.6)), (5, full(0.0, 0.7, 0.8, 0.9))],
        3: [(6, full(0.5, 0.1, 0.2, None)), (7, full(0.5, 0.4, None, None))],
        4: [(8, full(0.5, 0.1, 0.2, 0.3)[:25]), (9, []), (10, None), (11, full(0.5, 0.4, 0.5, 0.6))],
        5: [(12, None), (13, full(0.5, None, None, None))],
        None: [(14, full(0.5, 0.1, 0.2, 0.3))],
    }
    rows = [(v, s, k) for k, of_image in images.items() for v, s in of_image]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    c = duckdb.connect()
    c.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("rgba_png", "rgb_stretch"):
        want, got = c.sql(catalog.SQL[name]).fetchall(), map(tuple, catalog.QUERIES[name](spark, str(tmp_path)).collect())
        assert sorted(got, key=str) == sorted(want, key=str) and want
