"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source's target is its share of the wanted total, at most max_repeats times its own size; what a source cannot take
is shared among the others by weight (water filling). Of the target, complete epochs take every document; for the rest
each document draws an exponential key divided by its quality weight, and documents in key order fill the budget. A
document's draw depends on seed, doc_id and text length only, so reruns agree.

Prefix sums need no sort of a whole source: keys fall into buckets of about BUCKET_ROWS documents, bucket sums are
prefix-summed, and only the bucket in which a budget ends is sorted. Its next document is the one whose size comes
nearest to the gap that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORD = r"[^\x20\x09-\x0D]+"
PLAIN = r"(?<![^\x20\x09-\x0D])\p{L}+[.,;:!?]?(?![^\x20\x09-\x0D])"
BUCKET_ROWS = 2000


def quality(text: Column, size: Column) -> Column:
    """0.1 to 1: the share of words that are letters with at most one mark behind."""
    return F.lit(0.1) + F.lit(0.9) * F.coalesce(F.regexp_count(text, F.lit(PLAIN)) / F.nullif(size, F.lit(0)), F.lit(0.0))


def targets(sources: DataFrame, share: float, max_repeats: float, weights: tuple[float, ...]) -> DataFrame:
    """source, source_size, rows, target of sources(source, source_size, rows), one row per source.

    Sources by code point, null last, weigh weights in turn. Targets stop at max_repeats times the size; by rising
    size-to-weight ratio, sources are full until the level that the rest can share is reached. The windows run over one
    row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cap = F.lit(float(max_repeats)) * F.col("source_size")
    s = sources.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", cap)
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    # the level falls to its least value at the first source that is not full
    s = s.withColumn("open", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("level").alias("level")))).over(everything))
    return s.select("source", "source_size", "rows", F.coalesce(F.least(F.col("cap"), F.col("open.level") * F.col("w")), F.col("cap")).alias("target"))


def drawn(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, key of every row of docs(doc_id, text, source): key is an exponential draw by seed, doc_id
    and size, divided by the document's quality."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), quality(F.col("text"), size).alias("q"))
    u = (F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), "size", F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return rows.withColumn("key", -F.log(u) / F.col("q")).drop("q")


def mix(docs: DataFrame, share: float = 1.5, max_repeats: float = 2.0, weights: tuple[float, ...] = (3, 1, 2), seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of docs(doc_id, text, source).

    size counts the words of the whole text (null: 0); taken is size times the number of passes that the mix makes over
    the document. Null source is a source of its own. Documents without words take nothing. Repeated rows draw equal
    keys and count one by one; null doc_id draws as 0. Empty tables give an empty result.
    """
    rows = common.written(drawn(docs, seed), "mix")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    plan = targets(sources, share, max_repeats, weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = common.written(plan.withColumn("epochs", epochs.cast("long")).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "plan")
    # key / (1 + key) rises with the key and spreads keys of low and high quality alike over the buckets
    bucket = F.floor(F.col("key") / (1 + F.col("key")) * F.ceil(F.col("rows") / BUCKET_ROWS)).cast("long")
    keyed = rows.withColumnRenamed("source", "s").join(plan, F.expr("s <=> source")).drop("s").withColumn("bucket", bucket)
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"), F.first("rest").alias("rest"))
    upto = F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket"))
    ends = sums.withColumn("upto", upto).filter(F.col("upto") > F.col("rest")).groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("in_bucket")).alias("before"))).alias("e")).select(F.col("source").alias("s"), F.col("e.bucket").alias("end_bucket"), F.col("e.before").alias("before"))
    ends = common.written(ends, "ends")
    keyed = keyed.join(ends, F.expr("source <=> s"), "left").drop("s")
    whole = keyed.filter("end_bucket is null or bucket <> end_bucket").withColumn("picked", (F.col("end_bucket").isNull() & (F.col("rest") > 0)) | F.coalesce(F.col("bucket") < F.col("end_bucket"), F.lit(False)))
    last = keyed.filter("bucket = end_bucket")
    in_order = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    last = last.withColumn("n", F.row_number().over(in_order)).withColumn("sum", F.col("before") + F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("fits", F.col("sum") <= F.col("rest"))
    gap = F.col("rest") - F.coalesce(F.max(F.when(F.col("fits"), F.col("sum"))).over(Window.partitionBy("source")), F.col("before"))
    last = last.withColumn("gap", gap).withColumn("off", F.when(~F.col("fits") & (F.col("size") > 0), F.abs(F.col("size") - F.col("gap"))))
    nearest = F.min(F.when(F.col("off") < F.col("gap"), F.struct("off", "n"))).over(Window.partitionBy("source"))
    last = last.withColumn("picked", F.col("fits") | F.coalesce(F.col("n") == nearest["n"], F.lit(False)))
    taken = (F.col("size") * (F.col("epochs") + F.col("picked").cast("long"))).cast("long")
    names = ("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), taken.alias("taken"))
    return whole.select(*names).unionByName(last.select(*names))
