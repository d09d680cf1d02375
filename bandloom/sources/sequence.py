"""Sequence files of keyed binary records: a key, and a value in the record envelope of codecs.

The format has no DataFrame source, so reading and writing go through the file's own input and output classes.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codecs


def enveloped(value: Column, code: int) -> Column:
    """Payloads (binary) in an envelope with a type code."""

    @F.pandas_udf("binary")
    def run(col: pd.Series) -> pd.Series:
        return col.map(lambda b: None if b is None else codecs.envelope(code, bytes(b)))

    return run(value)


def write(df: DataFrame, path: str) -> None:
    """df(key string, value binary) as a folder of sequence files; rows without a key or value are left out."""
    rows = df.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")).filter("key is not null and value is not null")
    rows.rdd.map(lambda r: (bytearray(r["key"]), bytearray(r["value"]))).saveAsSequenceFile(path)


def read(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """key, value (as written) of the records whose key begins with prefix; inside and outside of other jobs alike."""
    rows = spark.sparkContext.sequenceFile(path).map(lambda r: (bytes(r[0]).decode(), bytes(r[1])))
    return spark.createDataFrame(rows, "key string, value binary").filter(F.col("key").startswith(prefix))


def decoded(value: Column) -> Column:
    """struct(code, text, height, width, samples, raw) of enveloped values by their type code: JSON as text, PNG as
    samples, all else raw; parts that do not decode are null."""

    @F.pandas_udf("code int, text string, height int, width int, samples array<int>, raw binary")
    def run(col: pd.Series) -> pd.DataFrame:
        out = []
        for b in col:
            row = [None] * 6
            try:
                code = bytes(b)[0]
                v = codecs.open_envelope(bytes(b))
                row[0] = code
                if isinstance(v, np.ndarray):
                    row[2:5] = (*v.shape, v.ravel())
                elif isinstance(v, bytes):
                    row[5] = v
                else:
                    row[1] = json.dumps(v)
            except (ValueError, TypeError, IndexError, KeyError, struct.error):
                pass
            out.append(row)
        return pd.DataFrame(out, columns=["code", "text", "height", "width", "samples", "raw"]).astype({"code": "Int32", "height": "Int32", "width": "Int32"})

    return run(value)


def read_images(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """key and the decoded parts of its value."""
    return read(spark, path, prefix).select("key", decoded(F.col("value")).alias("v")).select("key", "v.*")
