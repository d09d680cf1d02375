"""Image and record codecs: grey PNG, plain TIFF, typed records, KEY = VALUE metadata; readers and writers on them."""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Fixed type codes of the record envelope.
RAW, PNG, JSON_CODE = 0, 50, 51


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_encode(raster: np.ndarray, depth: int = 16) -> bytes:
    """Grey PNG of 8 or 16 bits; values are clamped to the range."""
    if depth not in (8, 16):
        raise ValueError("depth must be 8 or 16")
    a = np.clip(np.nan_to_num(np.asarray(raster, float)), 0, 2**depth - 1).astype(">u2" if depth == 16 else "u1")
    rows = np.concatenate([np.zeros((len(a), 1), np.uint8), a.view(np.uint8).reshape(len(a), -1)], axis=1)
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], depth, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def rgba_encode(rgba: np.ndarray) -> bytes:
    a = np.asarray(rgba, np.uint8)
    rows = np.concatenate([np.zeros((len(a), 1), np.uint8), a.reshape(len(a), -1)], axis=1)
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 6, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def rgba_image(channels: np.ndarray, mask: np.ndarray) -> bytes:
    """RGBA PNG of channels (height x width x 3), last channel first, opaque where mask is over 0."""
    alpha = (np.asarray(mask) > 0) * 255
    return rgba_encode(np.concatenate([np.asarray(channels)[:, :, ::-1], alpha[:, :, None]], axis=2))


def rgba_decode(data: bytes) -> np.ndarray:
    """The height x width x 4 bytes of an RGBA PNG without filters."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        head = struct.unpack(">IIBBBBB", data[at + 8 : at + 8 + n]) if kind == b"IHDR" else head
        body += data[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        at += 12 + n
    if not head or head[2:] != (8, 6, 0, 0, 0):
        raise ValueError("only RGBA images of 8 bits")
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(head[1], -1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].reshape(head[1], head[0], 4)


def png_decode(data: bytes) -> np.ndarray:
    """The raster of a grey PNG without filters; ValueError for a wrong header, checksum, depth, colour or filter."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + n]
        if struct.pack(">I", zlib.crc32(kind + part)) != data[at + 8 + n : at + 12 + n]:
            raise ValueError("checksum")
        at += 12 + n
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
    if not head or head[2] not in (8, 16) or head[3:] != (0, 0, 0, 0):
        raise ValueError("only grey images of 8 or 16 bits")
    width, height, depth = head[:3]
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, -1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return np.ascontiguousarray(rows[:, 1:]).view(">u2" if depth == 16 else "u1").reshape(height, width).astype(np.int32)


def tiff_encode(raster: np.ndarray) -> bytes:
    """One uncompressed strip of 16-bit samples, little-endian."""
    a = np.clip(raster, 0, 65535).astype("<u2")
    tags = [(256, 4, a.shape[1]), (257, 4, a.shape[0]), (258, 3, 16), (259, 3, 1), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 4, a.shape[0]), (279, 4, a.nbytes)]
    return b"II*\0" + struct.pack("<I", 8 + a.nbytes) + a.tobytes() + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in tags) + b"\0\0\0\0"


def tiff_decode(data: bytes) -> np.ndarray:
    """The first band of an uncompressed TIFF of integer samples in strips."""
    e = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if not e:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack(e + "I", data[4:8])
    (count,) = struct.unpack(e + "H", data[at : at + 2])
    tags = {}
    for i in range(count):
        tag, kind, n = struct.unpack(e + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        size, code = {1: (1, "B"), 3: (2, "H"), 4: (4, "I")}.get(kind, (0, ""))
        if size:
            where = at + 10 + 12 * i
            if size * n > 4:
                (where,) = struct.unpack(e + "I", data[where : where + 4])
            tags[tag] = struct.unpack(e + code * n, data[where : where + size * n])
    if tags.get(259, (1,))[0] != 1 or tags.get(277, (1,))[0] != 1:
        raise ValueError("only uncompressed single-band images")
    kind = {8: "u1", 16: e + ("i2" if tags.get(339, (1,))[0] == 2 else "u2"), 32: e + "i4"}[tags[258][0]]
    raw = b"".join(data[o : o + n] for o, n in zip(tags[273], tags[279], strict=True))
    return np.frombuffer(raw, kind).reshape(tags[257][0], tags[256][0]).astype(np.int32)


def decode_column(kind: str = "png"):
    """A pandas UDF from binary rasters to struct(height, width, samples); null for bad data."""
    decode = {"png": png_decode, "tiff": tiff_decode}[kind]

    @F.pandas_udf("height int, width int, samples array<int>")
    def run(col: pd.Series) -> pd.DataFrame:
        out = []
        for b in col:
            try:
                a = decode(bytes(b))
                out.append((*a.shape, a.ravel()))
            except (ValueError, KeyError, struct.error, TypeError):
                out.append((None, None, None))
        return pd.DataFrame(out, columns=["height", "width", "samples"]).astype({"height": "Int32", "width": "Int32"})

    return run


def metadata(text: str) -> dict:
    """Nested groups of KEY = VALUE lines; numbers where they parse, quotes removed."""
    root: dict = {}
    stack = [root]
    for line in text.splitlines():
        key, eq, value = (x.strip() for x in line.partition("="))
        if not eq:
            continue
        if key == "GROUP":
            stack.append(stack[-1].setdefault(value, {}))
        elif key == "END_GROUP":
            if len(stack) > 1:
                stack.pop()
        else:
            value = value.strip('"')
            try:
                stack[-1][key] = int(value) if re.fullmatch(r"[+-]?\d+", value) else float(value)
            except ValueError:
                stack[-1][key] = value
    return root


def metadata_json(text: Column) -> Column:
    """metadata() as JSON; the grammar nests, so no built-in function reads it."""

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        return col.map(lambda t: None if t is None else json.dumps(metadata(t)))

    return run(text)


def envelope(code: int, payload: bytes) -> bytes:
    return struct.pack(">BI", code, len(payload)) + payload


def open_envelope(data: bytes):
    code, n = struct.unpack(">BI", data[:5])
    payload = data[5 : 5 + n]
    return json.loads(payload) if code == JSON_CODE else png_decode(payload) if code == PNG else payload


# ---- files


def scan_files(spark: SparkSession, root: str, pattern: str = ".*") -> DataFrame:
    """path, directory, length of the files below root whose directory matches the pattern."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return files.withColumn("directory", F.element_at(F.split("path", "/"), -2)).filter(F.col("directory").rlike(pattern))


def band_name(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"_(B[0-9]+)_[^/]*\.TIF$", 1), F.lit(""))


def read_bands(spark: SparkSession, root: str, kind: str = "tiff") -> DataFrame:
    """image_key, band, height, width, samples of the band files below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).withColumn("band", band_name(F.col("path"))).filter("band is not null")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("image_key"), "band", decode_column(kind)("content").alias("r")).select("image_key", "band", "r.*")


def band_pixels(bands: DataFrame) -> DataFrame:
    """image_key, y, x, bands (name, value by name) of raster rows."""
    t = bands.select("image_key", "band", "width", F.posexplode("samples").alias("pos", "value"))
    return t.groupBy("image_key", F.floor(F.col("pos") / F.col("width")).cast("int").alias("y"), (F.col("pos") % F.col("width")).cast("int").alias("x")).agg(F.array_sort(F.collect_list(F.struct("band", "value"))).alias("bands"))


def file_list(spark: SparkSession, root: str, ending: str, prefix: str) -> DataFrame:
    """key: names below root with the ending, without it, behind another prefix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    return files.filter(F.col("path").endswith(ending)).select(F.concat(F.lit(prefix), F.regexp_extract("path", rf"([^/]+){re.escape(ending)}$", 1)).alias("key"))


def read_keyed_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """key and value (parsed by schema) of lines `key <tab> json`; lines that do not parse are left out."""
    t = spark.read.text(path).select(F.split("value", "\t", 2).alias("p"))
    return t.select(F.col("p")[0].alias("key"), F.from_json(F.try_element_at("p", F.lit(2)), schema).alias("value")).filter("value is not null")


def b64png(raster: np.ndarray, depth: int = 16) -> str:
    return base64.b64encode(png_encode(raster, depth)).decode()
