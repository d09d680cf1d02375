"""Language identification by a byte convolutional network, trained in numpy.

Bytes map to at most 64 symbols (the commonest of the training windows, one for the rest, one for padding). Filters of
several widths run over fixed windows of WINDOW bytes; each filter's maximum over a window feeds a softmax. A text's
scores are the means of its windows' probabilities; windows cover the whole text. In prediction a filter of width w is a
sum of lookups of symbol pairs, so a batch of windows needs a few array lookups and no matrix of one-hot vectors.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words

WINDOW, SYMBOLS, WIDTHS, FILTERS = 128, 64, (2, 3, 4), 12
#: Windows worked on at once, so that they stay in a core's cache.
CHUNK = 64
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double"


class Model(NamedTuple):
    langs: list[str]
    symbol: np.ndarray  # of each byte; 0 pads
    kernels: list[np.ndarray]  # of each width: width x SYMBOLS x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def cut(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (rows of WINDOW bytes, 0 behind the end) and the first window of each text."""
    counts = -(-np.diff(offs) // WINDOW)
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    at = offs[:-1][text] + (np.arange(first[-1]) - first[:-1][text]) * WINDOW
    index = at[:, None] + np.arange(WINDOW)
    return np.where(index < offs[1:][text][:, None], data[np.minimum(index, len(data) - 1)] if len(data) else 0, 0), first


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 5) -> Model:
    """Fits the network to byte windows; a third of them are shortened at random so that short texts are known too.

    In each epoch every language has as many windows as the one with the most; those with fewer repeat theirs.
    """
    rng = np.random.default_rng(seed)
    windows = words.LOWER[windows]
    common_bytes = np.argsort(-np.bincount(windows.ravel(), minlength=256)[1:], kind="stable")[: SYMBOLS - 2] + 1
    symbol = np.full(256, SYMBOLS - 1, np.uint8)
    symbol[0] = 0
    symbol[common_bytes] = np.arange(1, len(common_bytes) + 1)
    x_all, n_out, most = symbol[windows], len(langs), np.bincount(labels).max()
    p = [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)) for w in WIDTHS] + [np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, n_out)), np.zeros(n_out)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(np.concatenate([np.resize(rng.permutation(np.flatnonzero(labels == k)), most) for k in np.unique(labels)]))
        for i in range(0, len(order), batch):
            x, y = x_all[order[i : i + batch]].copy(), labels[order[i : i + batch]]
            for row in np.flatnonzero(rng.random(len(x)) < 0.33):
                x[row, rng.integers(8, WINDOW) :] = 0
            n, rows = len(x), np.arange(len(x))[:, None]
            top, pooled = [], []
            for w, kernel in zip(WIDTHS, p, strict=False):
                z = sum(kernel[k][x[:, k : WINDOW - w + 1 + k]] for k in range(w))
                top.append(z.argmax(1))
                pooled.append(np.take_along_axis(z, top[-1][:, None], 1)[:, 0])
            z = np.concatenate(pooled, 1) + p[-3]
            h = np.maximum(z, 0)
            d = softmax(h @ p[-2] + p[-1])
            d[np.arange(n), y] -= 1
            d /= n
            dz = (d @ p[-2].T) * (z > 0)
            g = [np.zeros_like(a) for a in p[: len(WIDTHS)]]
            for j, w in enumerate(WIDTHS):
                part = dz[:, j * FILTERS : (j + 1) * FILTERS]
                for k in range(w):
                    np.add.at(g[j][k], (x[rows, top[j] + k], np.arange(FILTERS)[None]), part)
            g += [dz.sum(0), h.T @ d, d.sum(0)]
            step += 1
            for a, b, mm, vv in zip(p, g, m, v, strict=True):
                mm += 0.1 * (b - mm)
                vv += 0.001 * (b * b - vv)
                a -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    p = [a.astype(np.float32) for a in p]
    return Model(langs, symbol, p[: len(WIDTHS)], *p[-3:])


class Predictor:
    """The network over many windows; pair tables are made once a worker."""

    def __init__(self, model: Model):
        self.model, self.tables = model, []
        for w, kernel in zip(WIDTHS, model.kernels, strict=True):
            parts = []
            for k in range(0, w - 1, 2):
                parts.append((k, True, (kernel[k][:, None] + kernel[k + 1][None]).reshape(-1, FILTERS)))
            if w % 2:
                parts.append((w - 1, False, kernel[w - 1]))
            self.tables.append((w, parts))

    def windows(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.model.langs)), np.float32)
        for i in range(0, len(windows), CHUNK):
            # positions first, so that maxima run over contiguous rows
            x = self.model.symbol[words.LOWER[windows[i : i + CHUNK].T]].astype(np.intp)
            pair, pooled = x[:-1] * SYMBOLS + x[1:], []
            for w, parts in self.tables:
                last, z = WINDOW - w + 1, None
                for k, two, table in parts:
                    add = table.take((pair if two else x)[k : k + last], axis=0)
                    z = add if z is None else np.add(z, add, out=z)
                pooled.append(z.max(0))
            h = np.maximum(np.concatenate(pooled, 1) + self.model.bias, 0)
            out[i : i + CHUNK] = softmax(h @ self.model.out + self.model.out_bias)
        return out

    def texts(self, data: np.ndarray, offs: np.ndarray) -> tuple[list, list]:
        """Predicted language and score of each text."""
        windows, first = cut(data, offs)
        sums = np.concatenate([np.zeros((1, len(self.model.langs))), np.cumsum(self.windows(windows), 0, dtype=np.float64)])
        mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)[:, None]
        best = mean.argmax(1)
        return [self.model.langs[b] for b in best], np.clip(mean[np.arange(len(best)), best], 0, 1).tolist()


def fit(docs: DataFrame, max_docs_per_lang: int = 400, windows_per_doc: int = 6, seed: int = 5) -> Model | None:
    """A model from docs(text, lang), or None without labelled text.

    Of each language about max_docs_per_lang different texts with a letter are drawn by a hash of the text, one at
    least, and of each windows_per_doc windows at even distances and the one at its first letter; this sample, bounded
    by the two parameters and the number of languages, is all that comes to the driver.
    """
    draw = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(unit := 1 << 31))
    labelled = docs.select("text", F.col("lang").cast("string").alias("lang"), draw.alias("draw")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # copies of a text count once, as they are drawn once
    different = labelled.select("lang", "draw").distinct()
    counts = {r["lang"]: (r["n"], r["least"]) for r in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).collect()}
    if not counts:
        return None
    limit = F.create_map(*[F.lit(x) for k, (n, least) in sorted(counts.items()) for x in (k, max(least + 1, min(unit, int(unit * max_docs_per_lang / n) + 1)))])
    length = F.length("text")
    cuts = F.transform(F.sequence(F.lit(0), F.lit(windows_per_doc - 1)), lambda i: F.substring(F.col("text"), (F.floor(length * i / windows_per_doc) + 1).cast("int"), F.lit(WINDOW)))
    letter = F.substring(F.col("text"), F.regexp_instr("text", F.lit(r"\p{L}")), F.lit(WINDOW))
    sample = labelled.filter(F.col("draw") < F.try_element_at(limit, F.col("lang"))).select("lang", "draw", F.array_distinct(F.concat(cuts, F.array(letter))).alias("cuts")).dropDuplicates(["lang", "draw"]).collect()
    langs = sorted(counts)
    rows = sorted((r["lang"], c.encode()[:WINDOW]) for r in sample for c in r["cuts"] if any(x.isalpha() for x in c))
    if not rows:
        return None
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    for i, (_, c) in enumerate(rows):
        windows[i, : len(c)] = np.frombuffer(c, np.uint8)
    return train(windows, np.array([langs.index(k) for k, _ in rows]), langs, seed=seed)


def predictor(model: Model | None):
    """A function of a batch with a text column without nulls: the languages and scores of its rows."""
    net = Predictor(model) if model else None

    def run(b: pa.RecordBatch) -> tuple[list[str], list[float]]:
        data, offs = words.column(b.column("text"))
        letters = [any(map(str.isalpha, t)) for t in b.column("text").to_pylist()]
        langs, scores = [], []
        for i, j in words.slices(offs):
            x, y = net.texts(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) if net else ([UNKNOWN] * (j - i), [0.0] * (j - i))
            langs += x
            scores += y
        return [x if ok else UNKNOWN for x, ok in zip(langs, letters, strict=True)], [y if ok else 0.0 for y, ok in zip(scores, letters, strict=True)]

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """SCHEMA for every row of docs(doc_id, text), over whole texts.

    Null and empty texts and texts without a letter are `und` with score 0, as is everything when no model could be
    fitted. Repeated rows get equal results, an empty table an empty one; other columns are ignored.
    """
    common.arrow(docs.sparkSession)

    def run(batches):
        of = predictor(model)
        for b in batches:
            langs, scores = of(b)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return common.id_text(docs).mapInArrow(run, SCHEMA)


def keep_known(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The rows of docs, all columns, whose text is in a learned language with a score of least or more.

    Every row is decided on its own text; see predict for null and empty ones.
    """

    def make():
        of = predictor(model)
        return lambda b: [x != UNKNOWN and y >= least for x, y in zip(*of(b), strict=True)]

    return common.filtered(docs, make)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 modulo 4; such rows are kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
