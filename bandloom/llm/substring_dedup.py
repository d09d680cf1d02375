"""Substring dedup of word windows with a count-min prefilter.

A window of `window` words is represented in the sketch by its anchor, the least hash of its grams of GRAM words. Equal
windows have equal anchors, so the number of documents with an anchor is never below the number with any of its
windows, and runs of neighbouring windows share one anchor.

1. Every document gives the digest of its words and its different anchors. Of documents with equal words the smallest
   doc_id goes on; the others are repeats as a whole.
2. Each input split sketches its anchors in DEPTH rows of cells (map-side counts), the sketches are merged, and cells
   counted once are dropped. The sketch is a table, wide in proportion to the anchors, so no task holds it and no size
   is ever too large to broadcast. Documents keep the anchors whose cells all remain; counts only overestimate, so no
   repeated window is lost.
3. The windows of those anchors alone, in those documents alone, are grouped by their words, for which 128 bits of their
   SHA-256 stand, to find the smallest document that has each; windows that start in a smaller one mark their words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words

WINDOW, GRAM, DEPTH, CELLS_PER_ANCHOR = 50, 10, 2, 8


def anchors(h: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window of one text, and the first window of each text."""
    grams, at = words.gram_hashes(h, first, gram)
    per, counts = window - gram + 1, np.maximum(np.diff(first) - window + 1, 0)
    start = np.concatenate([[0], np.cumsum(counts)])
    if not start[-1]:
        return np.zeros(0, np.uint64), start
    least = words.sliding_min(grams, per)  # runs over text ends too; those places are not taken
    return least[np.arange(start[-1]) + np.repeat(at[:-1] - start[:-1], counts)], start


def runs(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it in its text."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1][first[:-1] < len(values)]] = True
    return new


def word_list(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def sha(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def window_keys(w: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """Two numbers for each window of w that starts at one of starts: 128 bits of the SHA-256 of its words, joined by one
    space."""
    lengths = np.fromiter(map(len, w), np.int64, len(w))
    joined, ends = b" ".join(w), np.cumsum(lengths + 1) - 1
    spans = zip((ends[starts] - lengths[starts]).tolist(), ends[starts + window - 1].tolist(), strict=True)
    return np.frombuffer(b"".join(hashlib.sha256(joined[a:b]).digest()[:16] for a, b in spans), "<i8").reshape(-1, 2)


def surveyed(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, n_words, whole_sha256, anchors of every row."""
    schema = pa.list_(pa.int64())

    def run(batches):
        for b in batches:
            data, offs = words.column(b.column("text"))
            texts = b.column("text").to_pylist()
            counts, found = [], []
            for i, j in words.slices(offs):
                part = data[offs[i] : offs[j]]
                starts, ends, first = words.words(part, offs[i : j + 1] - offs[i])
                counts.append(np.diff(first))
                a, at = anchors(words.word_hashes(part, starts, ends), first, window, gram)
                new = runs(a, at)
                a, at = a[new].view(np.int64), np.concatenate([[0], np.cumsum(new)])[at]
                found += [np.unique(a[at[k] : at[k + 1]]) for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate([*counts, np.zeros(0, np.int64)])), pa.array([sha(word_list(t)) for t in texts], pa.string()), pa.array(found, schema)], ["doc_id", "n_words", "whole_sha256", "anchors"])

    return docs.mapInArrow(run, "doc_id long, n_words long, whole_sha256 string, anchors array<long>")


def estimated_repeated(rows: DataFrame, n: int) -> DataFrame:
    """The rows(doc_id, anchor), n in number, whose anchor the merged sketch counts more than once."""
    width = max(1 << 10, n * CELLS_PER_ANCHOR)
    cell = [F.pmod(F.xxhash64("anchor", F.lit(r)), F.lit(width)) for r in range(DEPTH)]
    sketch = rows.select(F.explode(F.array(*[F.struct(F.lit(r).alias("r"), c.alias("cell")) for r, c in enumerate(cell)])).alias("s")).groupBy("s.r", "s.cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("r", "cell")
    sketch = common.written(sketch, "sketch")
    for r, c in enumerate(cell):
        rows = rows.withColumn("cell", c).join(sketch.filter(F.col("r") == r).select("cell"), "cell", "left_semi").drop("cell")
    return rows


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of docs(doc_id, text).

    A word is removed if a window over it has a word sequence that also starts in a document with a smaller doc_id;
    windows are judged on the input. Null and empty texts and texts shorter than a window lose nothing. Rows without a
    doc_id neither lose nor cause anything. Rows that repeat a doc_id are one document and never repeat each other. An
    empty table gives an empty result; other columns are ignored.
    """
    common.arrow(docs.sparkSession)
    docs = common.id_text(docs)
    seen = common.written(surveyed(docs, window, gram), "windows")
    long = seen.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    wholes = common.written(long.groupBy("whole_sha256").agg(F.min("doc_id").alias("smallest")), "wholes")
    first = wholes.select(F.col("smallest").alias("doc_id")).distinct()
    rows = long.join(first, "doc_id", "left_semi").select("doc_id", F.explode("anchors").alias("anchor"))
    rows = common.written(rows, "anchors")
    likely = estimated_repeated(rows, rows.count())
    wanted = likely.groupBy("doc_id").agg(F.collect_set("anchor").alias("wanted"))
    # the only time texts move: those of documents with likely repeats, written for the two passes over them
    texts = common.written(docs.join(wanted, "doc_id"), "texts")

    def windows(batches):
        for b in batches:
            data, offs = words.column(b.column("text"))
            ids, want, whole = b.column("doc_id").to_numpy(), b.column("wanted"), b.column("text").to_pylist()
            out = []
            for i, j in words.slices(offs):
                part = data[offs[i] : offs[j]]
                starts, ends, first = words.words(part, offs[i : j + 1] - offs[i])
                a, at = anchors(words.word_hashes(part, starts, ends), first, window, gram)
                for k in range(j - i):
                    hit = np.flatnonzero(np.isin(a[at[k] : at[k + 1]].view(np.int64), want[i + k].values.to_numpy()))
                    if len(hit):
                        out.append((window_keys(word_list(whole[i + k]), hit, window), np.full(len(hit), ids[i + k]), hit.astype(np.int32)))
            for k in range(0, len(out), 50):
                key, d, s = (np.concatenate(x) for x in zip(*out[k : k + 50], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (key[:, 0], key[:, 1], d, s)], ["k1", "k2", "doc_id", "start"])

    found = texts.mapInArrow(windows, "k1 long, k2 long, doc_id long, start int")
    groups = found.groupBy("k1", "k2").agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest")).filter("smallest < largest").select("k1", "k2", "smallest")
    groups = common.written(groups, "groups")
    starts = found.join(groups, ["k1", "k2"]).filter("doc_id > smallest").groupBy("doc_id").agg(F.collect_set("start").alias("starts"))
    cut = texts.select("doc_id", "text").join(starts, "doc_id")

    def keep(batches):
        for b in batches:
            rows = []
            for text, begun in zip(b.column("text").to_pylist(), b.column("starts"), strict=True):
                w = word_list(text)
                at = begun.values.to_numpy()
                at = at[at <= len(w) - window]
                depth = np.zeros(len(w) + 1, np.int32)
                depth[at] += 1
                depth[at + window] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                rows.append((int(gone.sum()), sha([x for x, g in zip(w, gone.tolist(), strict=True) if not g]), sha(w)))
            n, s, whole = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(s, pa.string()), pa.array(whole, pa.string())], ["doc_id", "n_removed", "cut_sha256", "whole_sha256"])

    cut = common.written(cut.mapInArrow(keep, "doc_id long, n_removed long, cut_sha256 string, whole_sha256 string").dropDuplicates(["doc_id", "whole_sha256"]), "cut")
    out = seen.select("doc_id", "n_words", "whole_sha256").join(wholes, "whole_sha256", "left").join(cut, ["doc_id", "whole_sha256"], "left")
    repeat = F.coalesce((F.col("doc_id") > F.col("smallest")) & (F.col("n_words") >= window), F.lit(False))
    return out.select(
        "doc_id",
        "n_words",
        F.when(repeat, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(repeat, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"),
    )
