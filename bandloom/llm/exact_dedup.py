"""Exact dedup by skew-safe combining.

Rows are first counted by digest, a narrow shuffle. A digest that one row has needs no comparison. The texts of all
other digests combine in three steps: locally (map-side aggregation of each input split), within salted digest groups
(the salt is the input split's number, so a task sends at most one row of a text), and over the salts. Every step groups
by the digest and the full content. Only narrow tables (one row per text, without the text) are joined back to the rows.
Should one digest stand for several contents, the rows with that digest are joined by content as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SALTS = 16
#: So many digests that repeat, 16 bytes each, may be sent to every task to leave out other rows before the first
#: shuffle of texts; beyond, a join does it.
SENT_DIGESTS = 2_000_000


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def salted(docs: DataFrame, digest: Callable[[Column], Column], salts: int) -> DataFrame:
    """docs(doc_id, text) with their digest and salt."""
    return docs.select("doc_id", "text", digest(F.col("text")).alias("digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))


def groups(rows: DataFrame) -> DataFrame:
    """digest, text, keep_id, group_size of each different text of rows(doc_id, text, digest, salt)."""
    within = rows.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return within.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def of_digests(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows whose digest is among the digests, which are written, or (few) may share a hash with one of them."""
    if digests.count() > SENT_DIGESTS:
        return rows.join(digests, "digest", "left_semi")
    short = digests.select(F.xxhash64("digest").alias("_h")).distinct()
    return rows.withColumn("_h", F.xxhash64("digest")).join(F.broadcast(short), "_h", "left_semi").drop("_h")


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs(doc_id, text).

    Null text counts as empty. Of equal texts the row with the largest doc_id stays; a null doc_id is smaller than any
    other. Rows that repeat a doc_id and its text are one document: each gets the same result, and group_size counts
    all of them. An empty table gives an empty result. Other columns are ignored.
    """
    docs = common.id_text(docs)
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), sha(F.col("text")).alias("text_sha256"))
    table = common.written(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digests")
    texts = of_digests(salted(docs, digest, salts), table.filter("group_size > 1").select("digest"))
    several = common.written(groups(texts).groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("digest"), "several")
    if several.isEmpty():
        out = rows.join(table, "digest")
    else:
        one = rows.join(table.join(several, "digest", "left_anti"), "digest").select("doc_id", "keep_id", "group_size", "text_sha256")
        texts = common.written(of_digests(salted(docs, digest, salts), several).join(several, "digest", "left_semi"), "texts")
        more = texts.withColumn("text_sha256", sha(F.col("text"))).join(common.written(groups(texts), "groups"), ["digest", "text"])
        out = one.unionByName(more.select("doc_id", "keep_id", "group_size", "text_sha256"))
    return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")
