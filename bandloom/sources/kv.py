"""Key-value tables as Parquet folders of (key, value) with JSON values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "key string, value string"


def put(df: DataFrame, path: str, version: int | None = None) -> None:
    """Adds rows(key, value); values that are no JSON raise. Later versions win when read.

    Of equal keys in one call the greatest value is taken when read, so that every read agrees.
    """
    checked = df.select("key", F.when(F.try_parse_json("value").isNotNull() | F.col("value").isNull(), F.col("value")).otherwise(F.raise_error(F.lit("not JSON"))).alias("value"))
    checked.withColumn("version", F.lit(version).cast("long") if version is not None else F.unix_micros(F.current_timestamp())).write.mode("append").parquet(path)


def scan(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """key, value of the newest versions; both ends of a range belong to it."""
    t = spark.read.schema(SCHEMA + ", version long").parquet(path)
    if first is not None:
        t = t.filter(F.col("key") >= first)
    if last is not None:
        t = t.filter(F.col("key") <= last)
    return t.groupBy("key").agg(F.max_by("value", F.struct("version", "value")).alias("value"))


def first_values(rows: DataFrame, order: str) -> DataFrame:
    """key and its first value by order."""
    return rows.groupBy("key").agg(F.min_by("value", F.struct(order, "value")).alias("value"))


def lookup(keys: DataFrame, table: DataFrame) -> DataFrame:
    """The table rows of the keys; absent keys vanish."""
    return keys.select("key").distinct().join(table, "key")


def last_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
