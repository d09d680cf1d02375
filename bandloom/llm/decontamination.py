"""Benchmark decontamination by latent semantic retrieval.

Texts are TF-IDF vectors over FEATURES hashed words; document frequencies count every passage of PASSAGE words of the
corpus. A randomised SVD of a matrix with a row for each document of the corpus, all of its words, and for each passage
of the benchmark (half of the weight each) gives one latent space for all items. Its two passes are distributed: each
task sums its part of A'WA X, blocks of features are added up, and only a FEATURES x rank matrix comes to the driver.

Every document is searched for zones that may hold an item, then windows of the item's length in them are projected and
compared with the item by cosine. Candidate places are decided by the longest common subsequence with the item's words,
and for looser paraphrases by whether the item's answer stands there as well. Zones lose nothing that this check would
accept: a stretch that shares enough of an item's words for it also holds at least m of the item's n - need + m rarest
ones, and an index from these words to items finds every stretch that holds so many. So no pair of a window and an item
is ruled out by a lexical test that the final check would not fail too.

The benchmark is taken in blocks of ITEMS_BLOCK items, which bounds what is sent to the tasks; each block is a pass over
the documents, and no verdict depends on which items share a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words

FEATURES, RANK, EXTRA, PASSAGE = 1 << 13, 96, 8, 64
ITEMS_BLOCK = 5_000
MIN_COSINE = 0.4
#: The rarest words of an item that a zone has to hold.
GATE_WORDS = 6
#: Tasks that share a product, each of which sends one part of it, and rows that one holds at once.
PARTS, ROWS_AT_ONCE = 64, 256
#: Common subsequence over item words: enough alone, and enough with the answer.
CERTAIN, WITH_ANSWER = 0.8, 0.6
ANSWER_WORDS = 3
SCHEMA = "doc_id long, contaminated boolean, item_id long, n_items int, lcs double, cosine double"
#: A-Z lower-cased; ASCII other than letters and digits separates.
TABLE = np.array([b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def hashed(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the first word of each text."""
    part = TABLE[data]
    starts, ends, first = words.words(part, offs)
    return words.word_hashes(part, starts, ends), first


def text_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return hashed(raw, np.array([0, len(raw)]))[0]


def feature(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(FEATURES - 1)).astype(np.int64)


def passages(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end word of the passages, PASSAGE words each but the last of a text."""
    counts = -(-np.diff(first) // PASSAGE)
    at = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    starts = first[:-1][text] + (np.arange(at[-1]) - at[:-1][text]) * PASSAGE
    return starts, np.minimum(starts + PASSAGE, first[1:][text])


def each_slice(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offs = words.column(batch.column("text"))
    for i, j in words.slices(offs):
        yield i, j, *hashed(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])


def text_features(docs: DataFrame, cut: bool = False) -> DataFrame:
    """f: the features of the words of each text of docs that has any, in order; cut: of each of its passages."""

    def run(batches):
        for b in batches:
            for _, _, h, first in each_slice(b):
                at = np.append(passages(h, first)[0], len(h)) if cut else first
                f = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(feature(h), pa.int32()))
                yield pa.RecordBatch.from_arrays([f.filter(pc.greater(pc.list_value_length(f), 0))], ["f"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "f array<int>")


def each_part(f: pa.ListArray, size: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of the rows of f of about size features, these features, and where each row begins among them."""
    values, first = f.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(f.value_lengths().to_numpy())])
    for i, j in words.slices(first, size):
        yield i, j, values[first[i] : first[j]], first[i : j + 1] - first[i]


def frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of passages of all rows(f), and in how many each feature occurs; FEATURES rows come to the driver."""

    def run(batches):
        n, df = 0, np.zeros(FEATURES, np.int64)
        for b in batches:
            for _, _, f, first in each_part(b.column("f")):
                starts, ends = passages(f, first)
                n += len(starts)
                both = np.sort(np.repeat(np.arange(len(starts)), ends - starts) * FEATURES + f)
                if len(both):
                    df += np.bincount(both[np.r_[True, both[1:] != both[:-1]]] % FEATURES, minlength=FEATURES)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, FEATURES)), pa.array(np.concatenate([[n], df]))], ["f", "n"])

    found = rows.select("f").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, np.int64)
    for r in found:
        out[r["f"] + 1] = r["n"]
    return int(out[0]), out[1:]


def product(rows: DataFrame, idf: np.ndarray, x: np.ndarray, block: int = 256) -> np.ndarray:
    """A'W(A x) over the unit TF-IDF vectors of rows(f, w); block rows of features are added up at a time."""
    sent = rows.sparkSession.sparkContext.broadcast((idf, x))

    def part(batches: Iterator[pa.RecordBatch]):
        idf, x = sent.value
        out = np.zeros(x.shape, np.float64)
        a = np.zeros((ROWS_AT_ONCE, FEATURES), np.float32)
        for b in batches:
            for at in range(0, b.num_rows, ROWS_AT_ONCE):
                rows = b.slice(at, ROWS_AT_ONCE)
                n, w = rows.num_rows, rows.column("w").to_numpy().astype(np.float32)
                for i, j, f, first in each_part(rows.column("f")):
                    place = np.repeat(np.arange(i, j), np.diff(first)) * FEATURES + f
                    np.add.at(a.reshape(-1), place, idf[f])
                a[:n] /= np.maximum(np.linalg.norm(a[:n], axis=1, keepdims=True), 1e-12)
                out += a[:n].T @ (w[:, None] * (a[:n] @ x))
                a[:n] = 0
        starts = range(0, FEATURES, block)
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array([out[k : k + block].ravel() for k in starts], pa.list_(pa.float64()))], ["k", "m"])

    def add(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": p["k"].iloc[:1], "m": [np.sum(np.stack(p["m"].to_list()), 0)]})

    found = rows.select("f", "w").mapInArrow(part, "k long, m array<double>").groupBy("k").applyInPandas(add, "k long, m array<double>").collect()
    sent.unpersist()
    out = np.zeros(x.shape)
    for r in found:
        out[r["k"] : r["k"] + block] = np.reshape(r["m"], (block, -1))
    return out


def latent(docs: DataFrame, items: DataFrame, idf: np.ndarray, seed: int = 3) -> np.ndarray:
    """FEATURES x RANK right singular vectors of all docs(f) and items(f) by a randomised SVD with one power step."""
    weight = max(docs.count(), 1) / max(items.count(), 1)
    rows = docs.select("f", F.lit(1.0).alias("w")).unionByName(items.select("f", F.lit(weight).alias("w"))).coalesce(PARTS)
    x = np.random.default_rng(seed).normal(size=(FEATURES, min(RANK + EXTRA, FEATURES)))
    q = np.linalg.qr(product(rows, idf, x.astype(np.float32)))[0]
    q, r = np.linalg.qr(product(rows, idf, q.astype(np.float32)))
    # the span of the second product; its order of importance comes from the projected matrix
    u, _, _ = np.linalg.svd(r)
    return (q @ u)[:, :RANK].astype(np.float32)


class Item(NamedTuple):
    item_id: int
    words: list[int]  # hashes
    answer: list[int]
    distinct: frozenset[int]


class Index(NamedTuple):
    weighted: np.ndarray  # the latent space times the features' idf: FEATURES x RANK
    items: list[Item]
    vectors: np.ndarray  # items x RANK, unit length
    rare: np.ndarray  # sorted hashes of the items' rarest words
    at: np.ndarray  # for each of these its first place in of, and one more
    of: np.ndarray  # numbers of items
    least: np.ndarray  # for each item how many of its rarest words a zone holds, and within how many words
    span: np.ndarray


def need(n: int) -> int:
    """The least common subsequence that verdict accepts for an item of n words; fewer words than 8 are all needed."""
    return math.ceil(WITH_ANSWER * n - 1e-9) if n >= 8 else n


def index(block: list[tuple[int, str, str | None]], idf: np.ndarray, space: np.ndarray) -> Index | None:
    """An index of (item_id, text, answer or None) rows; items of over PASSAGE words are cut into passages."""
    items, vectors, weighted, pairs, least = [], [], space * idf[:, None], [], []
    for item_id, text, answer in block:
        h = text_hashes(text or "")
        given = text_hashes(answer) if answer else None
        for i in range(0, len(h), PASSAGE):
            part = h[i : i + PASSAGE] if len(h) - i >= PASSAGE // 4 or not i else h[-PASSAGE:]
            ranked = part[np.lexsort((part, -idf[feature(part)]))]
            least.append(min(GATE_WORDS, need(len(part))))
            pairs += [(w, len(items)) for w in set(ranked[: len(part) - need(len(part)) + least[-1]].tolist())]
            answer_words = ranked[:ANSWER_WORDS] if given is None or not len(given) else given
            items.append(Item(item_id, part.tolist(), answer_words.tolist(), frozenset(part.tolist())))
            vectors.append(weighted[feature(part)].sum(0))
    if not items:
        return None
    v = np.stack(vectors)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    pairs.sort()
    rare, at = np.unique(np.array([w for w, _ in pairs], np.uint64), return_index=True)
    n = np.array([len(item.words) for item in items])
    return Index(weighted, items, v, rare, np.append(at, len(pairs)), np.array([k for _, k in pairs]), np.array(least), n + n // 2 + 2)


def common_subsequence(item: list[int], place: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in place:
        u = row & masks.get(w, 0)
        row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def verdict(item: Item, place: np.ndarray) -> tuple[float, bool]:
    """Common share of the item's words in the best stretch of place, and whether that is contamination.

    A stretch in which fewer words are the item's than a verdict needs has no long enough subsequence and is passed over.
    """
    n, best, leaked = len(item.words), 0.0, False
    span, least = n + n // 2 + 2, need(n)
    shared = np.concatenate([[0], np.cumsum(np.fromiter(map(item.distinct.__contains__, place.tolist()), bool, len(place)))])
    if shared[-1] < least:
        return best, leaked
    for i in range(0, max(1, len(place) - span + max(1, n // 4)), max(1, n // 4)):
        if shared[min(i + span, len(place))] - shared[i] < least:
            continue
        part = place[i : i + span].tolist()
        share = common_subsequence(item.words, part) / n
        best = max(best, share)
        # a few words common to any text are no evidence unless all are there
        leaked |= share >= CERTAIN if n >= 8 else share == 1.0
        leaked |= n >= 8 and share >= WITH_ANSWER and set(item.answer) <= set(part)
    return best, leaked


def zones(h: np.ndarray, first: np.ndarray, ix: Index) -> Iterator[tuple[int, int, int, int]]:
    """Text, item number, start and end word of the zones that may hold an item: every stretch of span words with least
    of its rarest words is in one."""
    if not len(h) or not len(ix.rare):
        return
    code = np.minimum(np.searchsorted(ix.rare, h), len(ix.rare) - 1)
    hit = np.flatnonzero(ix.rare[code] == h)
    code = code[hit]
    counts = ix.at[code + 1] - ix.at[code]
    item = ix.of[np.repeat(ix.at[code] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
    order = np.argsort(item, kind="stable")  # then by place
    item, place = item[order], np.repeat(hit, counts)[order]
    i = np.flatnonzero(np.arange(len(item)) + ix.least[item] <= len(item))
    j = i + ix.least[item[i]] - 1
    text = np.searchsorted(first, place, "right") - 1
    ok = (item[i] == item[j]) & (place[j] - place[i] < ix.span[item[i]]) & (text[i] == text[j])
    open_ = None
    for k, t, a, b in zip(item[i[ok]].tolist(), text[i[ok]].tolist(), (place[j[ok]] - ix.span[item[i[ok]]] + 1).tolist(), (place[i[ok]] + ix.span[item[i[ok]]]).tolist(), strict=True):
        a, b = max(a, int(first[t])), min(b, int(first[t + 1]))
        if open_ and open_[:2] == (t, k) and a <= open_[3]:
            open_ = (t, k, open_[2], max(b, open_[3]))
        else:
            if open_:
                yield open_
            open_ = (t, k, a, b)
    if open_:
        yield open_


def best_cosine(f: np.ndarray, k: int, ix: Index) -> float:
    """The greatest cosine of item k with a window of its length, a quarter of it apart, of the words with features f."""
    n = len(ix.items[k].words)
    sums = np.concatenate([np.zeros((1, ix.weighted.shape[1])), np.cumsum(ix.weighted[f], 0, dtype=np.float64)])
    start = np.unique(np.append(np.arange(0, max(len(f) - n, 0) + 1, max(1, n // 4)), max(len(f) - n, 0)))
    x = sums[np.minimum(start + n, len(f))] - sums[start]
    return float((x @ ix.vectors[k] / np.maximum(np.linalg.norm(x, axis=1), 1e-12)).max())


def search(h: np.ndarray, first: np.ndarray, ix: Index) -> list[tuple]:
    """For each text: contaminated, item_id, n_items, lcs, cosine."""
    f, places = feature(h), {}
    for text, k, a, b in zones(h, first, ix):
        if (c := best_cosine(f[a:b], k, ix)) >= MIN_COSINE:
            share, leaked = verdict(ix.items[k], h[a:b])
            places.setdefault((text, k), []).append((leaked, share, c))
    out: dict[int, list[tuple]] = {}
    for (text, k), found in places.items():
        out.setdefault(text, []).append((any(x for x, _, _ in found), max(x for _, x, _ in found), max(c for *_, c in found), ix.items[k].item_id))
    rows = []
    for text in range(len(first) - 1):
        found = sorted(out.get(text, []), key=lambda x: (-x[0], -x[1], x[3]))
        leaks = {x[3] for x in found if x[0]}
        rows.append((bool(leaks), found[0][3] if leaks else None, len(leaks), found[0][1] if found else 0.0, found[0][2] if found else 0.0))
    return rows


def searches(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """For each block of benchmark(item_id, text and, if there, answer) a function that tasks call to get a function of
    a batch with a text column without nulls: the results of search for its rows. docs(text): the whole corpus."""
    spark = docs.sparkSession
    common.arrow(spark)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    blocks = -(-items.count() // ITEMS_BLOCK)
    if not blocks:
        return
    rows = common.written(text_features(docs), "features")
    total, df = frequencies(rows)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)
    space = latent(rows, text_features(items, cut=True), idf)
    common.remove(rows)
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        ix = index(sorted((r["item_id"] if r["item_id"] is not None else -1, r["text"] or "", r["answer"]) for r in block), idf, space)
        if ix is not None:
            sent = spark.sparkContext.broadcast(ix)
            yield lambda sent=sent: lambda b, ix=sent.value: [row for _, _, h, first in each_slice(b) for row in search(h, first, ix)]


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """SCHEMA for every row of docs(doc_id, text), against benchmark(item_id, text and, if there, answer).

    item_id is the item that fits best (null if none is contained), n_items how many are, lcs and cosine the greatest
    found. Null and empty texts are clean; items without words are passed over; without items all is clean. Repeated
    rows get equal results, an empty table an empty one. Other columns are ignored.
    """
    docs = common.id_text(docs)
    makes = list(searches(docs, benchmark))
    key = "row" if len(makes) > 1 else "doc_id"
    if len(makes) > 1:  # the blocks' results meet again by row
        docs = common.written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    outs = []
    for make in makes:

        def run(batches, make=make):
            find = make()
            kinds = (pa.bool_(), pa.int64(), pa.int32(), pa.float64(), pa.float64())
            for b in batches:
                got = find(b)
                yield pa.RecordBatch.from_arrays([b.column(key), *(pa.array([r[i] for r in got], kind) for i, kind in enumerate(kinds))], [key, "contaminated", "item_id", "n_items", "lcs", "cosine"])

        outs.append(docs.mapInArrow(run, SCHEMA.replace("doc_id", key)))
    if not outs:
        return docs.select("doc_id", F.lit(False).alias("contaminated"), F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("n_items"), F.lit(0.0).alias("lcs"), F.lit(0.0).alias("cosine"))
    if len(outs) == 1:
        return outs[0]
    every = outs[0]
    for o in outs[1:]:
        every = every.unionByName(o)
    best = F.max_by(F.struct("item_id", "lcs", "cosine"), F.struct("contaminated", "lcs", -F.col("item_id"), "cosine"))
    found = every.groupBy("row").agg(F.max("contaminated").alias("contaminated"), best.alias("b"), F.sum("n_items").cast("int").alias("n_items"))
    return docs.select("doc_id", "row").join(found, "row").select("doc_id", "contaminated", "b.item_id", "n_items", "b.lcs", "b.cosine")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no item of benchmark; see decontaminate."""
    out = docs
    for make in searches(common.id_text(docs), benchmark):

        def keep(make=make):
            find = make()
            return lambda b: [not row[0] for row in find(b)]

        out = common.filtered(out, keep)
    return out
