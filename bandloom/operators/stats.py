"""Grey-band statistics, histograms and their comparison, quantile maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gray(spectrum: Column) -> Column:
    """Sum of squares over the bands."""
    return F.aggregate(spectrum, F.lit(0.0), lambda a, v: a + v * v)


def trimmed(values: DataFrame, key: str = "image_key", column: str = "gray", at: float = 0.99) -> DataFrame:
    """values with n (rows of the key before trimming), strictly below the percentile."""
    cuts = values.groupBy(key).agg(F.percentile(column, F.lit(at)).alias("cut"), F.count(F.lit(1)).alias("n"))
    return values.join(cuts, key).filter(F.col(column) < F.col("cut"))


def gray_band_stats(pixels: DataFrame) -> DataFrame:
    """Per image: pixels, mean and population sigma of the trimmed grey band, shares one sigma above and below."""
    t = trimmed(pixels.select("image_key", gray(F.col("spectrum")).alias("gray")))
    s = t.groupBy("image_key").agg(F.avg("gray").alias("mean"), F.stddev_pop("gray").alias("sigma"))
    share = lambda cond: F.sum(F.when(cond, 1).otherwise(0)) / F.first("n")
    return t.join(s, "image_key").groupBy("image_key").agg(F.first("n").alias("num_pixels"), F.first("mean").alias("mean"), F.first("sigma").alias("sigma"), share(F.col("gray") > F.col("mean") + F.col("sigma")).alias("plus_one_sigma"), share(F.col("gray") < F.col("mean") - F.col("sigma")).alias("minus_one_sigma"))


def histogram(values: DataFrame, key: str, column: str, bins: int = 100) -> DataFrame:
    """key, bin, n over [min, max] of each key, the last bin closed; empty bins count 0."""
    ends = values.groupBy(key).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.coalesce(F.least(F.floor((F.col(column) - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = values.join(ends, key).groupBy(key, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = ends.select(key, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, [key, "bin"], "left").select(key, "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def peaks(hist: DataFrame, key: str, valley: bool = False) -> DataFrame:
    """Bins that no bin from 3 before to 2 behind exceeds (valley: falls below)."""
    w = Window.partitionBy(key).orderBy("bin").rowsBetween(-3, 2)
    return hist.withColumn("best", (F.min if valley else F.max)("n").over(w)).filter("n = best").select(key, "bin", "n")


def similarity(hist: DataFrame, key: str) -> DataFrame:
    """a, b, correlation, chi2 of each ordered pair of keys, as histograms over one set of bins; bins empty in both do
    not count in chi2. Histograms are few and short, and join bin by bin."""
    l, r = hist.select(F.col(key).alias("a"), "bin", F.col("n").cast("double").alias("p")), hist.select(F.col(key).alias("b"), "bin", F.col("n").cast("double").alias("q"))
    chi = F.sum(F.when(F.col("p") + F.col("q") > 0, F.pow(F.col("p") - F.col("q"), 2) / (F.col("p") + F.col("q"))).otherwise(0.0)) * 0.5
    return l.join(r, "bin").filter("a <> b").groupBy("a", "b").agg(F.corr("p", "q").alias("correlation"), chi.alias("chi2"))


def outliers(pairs: DataFrame) -> DataFrame:
    """The key with the highest mean correlation and that with the highest mean chi2, above 0, the lowest key of equals."""
    m = pairs.groupBy("a").agg(F.round(F.avg("correlation"), 9).alias("correlation"), F.round(F.avg("chi2"), 9).alias("chi2"))
    best = lambda c: F.max_by("a", F.when(F.col(c) > 0, F.struct(F.col(c), -F.col("a"))))
    return m.agg(best("correlation").alias("by_correlation"), best("chi2").alias("by_chi2"))


def run_means(statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: images and the mean of each statistic over all images of a run."""
    return statistics.agg(F.count(F.lit(1)).alias("images"), *[F.avg(c).alias(c) for c in columns])


def outlier_image(pairs: DataFrame) -> DataFrame:
    """One row, outlier: the key whose histogram has the greatest mean ratio of correlation to chi2 to all others, above
    0; the lowest key of equals. Pairs without difference have an infinite ratio."""
    ratio = F.when(F.col("chi2") == 0, F.lit(float("inf"))).otherwise(F.col("correlation") / F.nullif("chi2", F.lit(0.0)))
    m = pairs.groupBy("a").agg(F.avg(ratio).alias("ratio"))
    return m.agg(F.max_by("a", F.when(F.col("ratio") > 0, F.struct("ratio", -F.col("a")))).alias("outlier"))


def run_summary(statistics: DataFrame, histograms: DataFrame, pixels: str = "num_pixels") -> DataFrame:
    """One row: images, average_pixels, outlier, of statistics(image_key, pixels) and histograms(image_key, bin, n)."""
    s = statistics.agg(F.count(F.lit(1)).alias("images"), F.avg(pixels).alias("average_pixels"))
    return s.join(F.broadcast(outlier_image(similarity(histograms, "image_key"))))  # one row each


def position_histogram(pixels: DataFrame, key: str, width: int, height: int, bin_size: int) -> DataFrame:
    """key, ix, iy, n over int(W/size) x int(H/size) equal bins, the last ones closed."""
    nx, ny = width // bin_size, height // bin_size
    at = lambda c, n, size: F.least(F.floor(F.col(c) * n / size), F.lit(n - 1)).cast("int")
    return pixels.groupBy(key, at("x", nx, width).alias("ix"), at("y", ny, height).alias("iy")).agg(F.count(F.lit(1)).alias("n"))


def cut_levels(hist: DataFrame, key: str) -> DataFrame:
    """50th and 95th percentile of the positive bins."""
    p = hist.filter("n > 0").groupBy(key)
    return p.agg(F.percentile("n", F.lit(0.5)).alias("cut50"), F.percentile("n", F.lit(0.95)).alias("cut95"))


def quantiles(values: DataFrame, column: str, at: Sequence[float], clamp: float = 1.0, parts: int = 128) -> DataFrame:
    """One row, q: the exact percentiles (linear between neighbours) of the column, null without values; of values
    clamped at a percentile of theirs, if clamp is given.

    Approximate quantiles cut the values into bins of about equal size; the exact counts of the bins tell which of them
    hold the few ranks that are needed, and only these are sorted, each by itself. Equal values are one row throughout.
    """
    v = values.select(F.col(column).cast("double").alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    edges = v.agg(F.percentile_approx("v", F.array(*[F.lit(i / parts) for i in range(1, parts)]), F.lit(10_000)).alias("edges"))
    binned = v.join(F.broadcast(edges)).select("v", "c", F.size(F.filter("edges", lambda e: e < F.col("v"))).alias("bin"))  # one row
    order = Window.orderBy("bin")  # of the bins
    sizes = binned.groupBy("bin").agg(F.sum("c").alias("n"))
    sizes = sizes.withColumns({"before": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "total": F.sum("n").over(Window.partitionBy())})
    place = [F.lit(float(p)) * (F.col("total") - 1) for p in (*at, clamp)]
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), p.alias("place"), r.cast("long").alias("rank")) for i, p in enumerate(place) for r in (F.floor(p), F.ceil(p))])
    wanted = sizes.withColumn("w", F.explode(ranks)).filter("w.rank >= before and w.rank < before + n").select("bin", "before", "w.*").distinct()
    upto = F.sum("c").over(Window.partitionBy("bin").orderBy("v"))
    own = binned.join(F.broadcast(wanted.select("bin").distinct()), "bin", "left_semi").withColumn("upto", upto)
    found = own.withColumnRenamed("bin", "b").join(F.broadcast(wanted), F.expr("b = bin and rank < before + upto and rank >= before + upto - c"))  # two ranks a percentile
    each = found.groupBy("i").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), (F.first("place") - F.floor(F.first("place"))).alias("share"))
    all_ = each.agg(F.array_sort(F.collect_list(F.struct("i", "lo", "hi", "share"))).alias("e"))
    between = lambda lo, hi, share: lo + (hi - lo) * share
    top = F.get("e", F.lit(len(at)))
    cut = between(top["lo"], top["hi"], top["share"])  # clamping keeps the order, so it can follow the choice of ranks
    q = F.transform(F.slice("e", 1, len(at)), lambda e: between(F.least(e["lo"], cut), F.least(e["hi"], cut), e["share"]))
    return all_.select(F.when(F.size("e") > 0, q).alias("q"))


def score_quantiles(scores: DataFrame, column: str, clamp: float = 0.99, steps: int = 11) -> DataFrame:
    """quantile (500 to 1000 by 50) and score: percentiles of the different scores, clamped at a percentile."""
    d = scores.select(F.col(column).alias("s")).filter("s is not null").distinct()
    at = [0.5 + 0.5 * i / (steps - 1) for i in range(steps)]
    q = quantiles(d, "s", at, clamp)
    return q.select(F.posexplode("q").alias("i", "score")).select((F.lit(500) + F.col("i") * (500 // (steps - 1))).cast("int").alias("quantile"), "score")


def normalized(scores: DataFrame, column: str, quantiles: DataFrame) -> DataFrame:
    """scores with norm: 0 below the map, 1000 from its top, linear between neighbours. The map is a row of arrays."""
    m = quantiles.agg(F.array_sort(F.collect_list(F.struct("score", "quantile"))).alias("m"))  # a few entries
    s = F.col(column)
    below = F.filter("m", lambda e: e["score"] <= s)
    k = F.size(below)
    lo, hi = F.get("m", k - 1), F.get("m", k)
    norm = F.when(s.isNull(), None).when(k == 0, 0.0).when(k == F.size("m"), 1000.0).otherwise(lo["quantile"] + (hi["quantile"] - lo["quantile"]) * (s - lo["score"]) / (hi["score"] - lo["score"]))
    return scores.join(F.broadcast(m)).withColumn("norm", norm).drop("m")
