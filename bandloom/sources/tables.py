"""Tables as images: a pixel per row, one array of doubles per spectrum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Width of the grid on which rows of the embeddings table stand as pixels.
GRID = 25


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows of a table as a stream, whether it is one file or a folder of parts.

    The name stands as a pattern, since a stream takes a plain path for a folder only.
    """
    return spark.readStream.schema(read(spark, sf_dir, table).schema).parquet(f"{sf_dir}/[{table[0]}]{table[1:]}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_key, vec_id, y, x, spectrum of the embeddings table."""
    e = read(spark, sf_dir, "embeddings")
    return e.select(F.col("label").alias("image_key"), "vec_id", F.floor(F.col("vec_id") / GRID).cast("int").alias("y"), (F.col("vec_id") % GRID).cast("int").alias("x"), F.col("embedding").cast("array<double>").alias("spectrum"))


def tall(pixels: DataFrame, bands: int | None = None) -> DataFrame:
    """One row per pixel and band (from 1), value; bands keeps the first so many, sliced before the rows multiply."""
    s = F.slice("spectrum", 1, bands) if bands else F.col("spectrum")
    keep = [c for c in pixels.columns if c != "spectrum"]
    return pixels.select(*keep, F.posexplode(s).alias("band", "value")).withColumn("band", F.col("band") + 1)
