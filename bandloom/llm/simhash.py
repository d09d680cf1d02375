"""SimHash near-dedup with the generalised pigeonhole principle.

Two fingerprints that differ in at most `distance` bits differ in at most t_i bits of some partition i of the bits, when
the sum of t_i + 1 over the partitions is distance + 1. Correlated bits are grouped into one partition, and dynamic
programming allots the t_i so that the rows to probe and the estimated candidates cost least; both rest on bit counts
and pair counts of all fingerprints. A probe is a partition's bits with t_i of them masked, so equal probes mean a
distance of t_i at most there. Fingerprints with equal probes are compared in numpy.

A bucket never yields its links: it yields a spanning forest of them, at most one edge a row, and buckets of over
BLOCK rows are cut into blocks whose pairs of blocks are separate groups. Equal fingerprints are one node throughout.

Groups by Jaccard similarity check the links of near fingerprints exactly, and then find what no fingerprint of 64 bits
can be relied on for, pairs just over the least similarity, with a prefix filter, which loses no pair. In any one order
of all shingles, two sets of similarity t share one of the first n - ceil(t n) + 1 of each. The order puts common
shingles last, by the counts of buckets of hashes over all documents, and matters for the cost only. A first round checks every document
against the first one of a bucket, which is linear and joins groups of copies; only buckets that still hold documents of
different components go on, to rounds that take the nearest candidates of each row that the links found before do not
connect. A candidate is left out beforehand only where the sets provably differ too much: with one parity bit a bucket
of hashed shingles, two sets differ in at least as many shingles as their parities in bits. Buckets carry a short row of parities; before texts are
moved, pairs are tested with one of at least two bits for each shingle, which leaves little under the least similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, components, words

BITS = 64
BLOCK, CHUNK = 1024, 100_000
#: Parity bits of a shingle set, as long columns.
PARITY = [f"p{i}" for i in range(8)]
#: Pairs that one step of a comparison holds, and the candidates of a row that the rounds before the last check.
PAIRS, PARTNERS = 4_000_000, (4, 64)
#: Fingerprints of shingle sets that differ in so many bits are candidates; others are the prefix filter's.
NEAR_BITS = 3
#: So many ids, 8 bytes each, may be sent to every task to leave out other texts before they are moved.
SENT_IDS = 2_000_000
#: Texts that are compared with one text in one task.
PARTNERS_PER_TASK = 256
#: Shingles are counted by buckets of their hashes; one is common from COMMON_COUNT documents in ORDER_DOCS (or in fewer).
BUCKETS, ORDER_DOCS, COMMON_COUNT = 1 << 23, 50_000, 8
#: Counts of one row while the tasks' tables are added up.
COUNTS = 1 << 14
#: Relative costs of a probe row (shuffled and sorted) and of a compared pair.
PROBE_COST, PAIR_COST = 2.0, 0.01
SCHEMA = "doc_id long, fp long"


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A fingerprint for each run hashes[first[i]:first[i+1]]: the bits set in over half of them; 0 for an empty run."""
    out, counts = np.zeros(len(first) - 1, np.uint64), np.diff(first)
    some = np.flatnonzero(counts)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for lo in range(0, len(some), 256):
        part = some[lo : lo + 256]
        sums = np.empty((len(part), BITS), np.int64)
        for row, i in enumerate(part):
            bits = np.unpackbits(hashes[first[i] : first[i + 1]].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums[row] = bits.sum(0, dtype=np.int32)
        out[part] = ((2 * sums > counts[part][:, None]) * weights).sum(1, dtype=np.uint64)
    return out


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 with seed 42 of each shingle of lower-cased words, repeats included; the whole of fewer words."""
    w = text.translate(words.LOWER_BYTES).split()
    if not w:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(w), xxhash.xxh64_intdigest
    n = len(w) - size + 1
    if n <= 1:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = (ends[:n] - [len(x) + 1 for x in w[:n]]).tolist()
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """SCHEMA of docs(doc_id, text): fp over shingles of size words, repeats included."""
    common.arrow(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = []
            for t in b.column("text").to_pylist():
                h = shingle_hashes(t.encode("utf-8", "surrogatepass"), size)
                fp.append(int(majority(h, np.array([0, len(h)]))[0]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(fp, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return common.id_text(docs).mapInArrow(run, SCHEMA)


def shingle_sets(col: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The different hashes of each text's shingles of size words, sorted."""
    data, offs = words.column(col)
    for i, j in words.slices(offs):
        part = words.LOWER[data[offs[i] : offs[j]]]
        starts, ends, first = words.words(part, offs[i : j + 1] - offs[i])
        grams, at = shingles(words.word_hashes(part, starts, ends), first, size)
        yield from (np.unique(grams[at[k] : at[k + 1]]) for k in range(j - i))


def set_prints(docs: DataFrame, size: int, least: float) -> DataFrame:
    """doc_id of docs(doc_id, text) and, of its set of shingles of size words: a digest, its size n, PARITY, the
    fingerprint fp, the hashes of its prefix for similarity least, in plain (surely not in over a small share of all
    documents) and frequent, and parities in sketch."""
    common.arrow(docs.sparkSession)
    docs = common.id_text(docs)
    top = common_shingles(docs, size)
    by = np.argsort(top)
    sent = docs.sparkSession.sparkContext.broadcast((top[by], by))

    def run(batches):
        known, rank = sent.value
        lists = pa.list_(pa.int64())
        for b in batches:
            digests, fps, plain, frequent, sketches = [], [], [], [], []
            for s in shingle_sets(b.column("text"), size):
                digests.append(set_digest(s))
                fps.append(majority(s, np.array([0, len(s)]))[0])
                first, often = prefix(s, known, rank, least, BUCKETS - 1)
                plain.append(first[~often].view(np.int64))
                frequent.append(first[often].view(np.int64))
                sketches.append(parities(s, 1 << max(9, (2 * len(s) - 1).bit_length())).tobytes())
            columns = [*np.array(digests, np.uint64).reshape(-1, 2 + len(PARITY)).T, np.array(fps, np.uint64)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns), pa.array(plain, lists), pa.array(frequent, lists), pa.array(sketches, pa.binary())], names)

    names = ["doc_id", "digest", "n", *PARITY, "fp", "plain", "frequent", "sketch"]
    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names[:-3]) + ", plain array<long>, frequent array<long>, sketch binary")


def parities(grams: np.ndarray, bits: int) -> np.ndarray:
    """One bit for each of the buckets of different hashes, in bytes; bits is a power of two."""
    return np.packbits((np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8))


def parities_differ(a: bytes, b: bytes) -> int:
    """In how many bits two rows of parities differ, the longer one folded to the length of the shorter."""
    a, b = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def set_digest(grams: np.ndarray) -> np.ndarray:
    """Sum, number and parities of different hashes."""
    return np.concatenate([[grams.sum(dtype=np.uint64), np.uint64(len(grams))], parities(grams, BITS * len(PARITY)).view(np.uint64)])


def similarity_bound(rows: pd.DataFrame, least: float):
    """Takes row numbers i, j of rows(n, PARITY); False where the Jaccard similarity of the two sets is surely under least."""
    n, parity = rows["n"].to_numpy(), rows[PARITY].to_numpy(np.int64).view(np.uint64)

    def may(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = np.maximum(np.bitwise_count(parity[i] ^ parity[j]).sum(1, dtype=np.int64), np.abs(n[i] - n[j]))
        return differ * (1 + least) <= (n[i] + n[j]) * (1 - least) * (1 + 1e-9)

    return may


def shingles(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of size words; a shorter text is one shingle."""
    grams, at = words.gram_hashes(h, first, size)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if len(short):
        grams = np.insert(grams, at[short], words.spans_hash(h, first[short], first[short + 1], words.WORD_BASE))
        at = at + np.concatenate([[0], np.cumsum((np.diff(first) > 0) & (np.diff(first) < size))])
    return grams, at


# ---- partitions and thresholds


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows of fps(fp), and for each two bits how many rows have both; 64 rows come to the driver."""

    def run(batches: Iterator[pd.DataFrame]):
        total = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            bits = np.unpackbits(b["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        yield pd.DataFrame({"bit": np.arange(BITS)} | {f"c{i}": total[:, i] for i in range(BITS)})

    names = [f"c{i}" for i in range(BITS)]
    rows = fps.select("fp").mapInPandas(run, "bit int, " + ", ".join(f"{n} long" for n in names)).groupBy("bit").agg(*[F.sum(n).alias(n) for n in names]).orderBy("bit").collect()
    both = np.array([[r[n] for n in names] for r in rows], np.int64) if rows else np.zeros((BITS, BITS), np.int64)
    return fps.count(), both


def partitions(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of about equal size; each starts with a free bit and takes those most correlated with the group."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, out = set(range(BITS)), []
    for k in range(m):
        want = len(free) // (m - k)
        rest = sorted(free)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        free.remove(group[0])
        while len(group) < want:
            b = max(sorted(free), key=lambda x: (corr[x, group].mean(), -x))
            group.append(b)
            free.remove(b)
        out.append(group)
    return out


def distance_shares(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of pairs that differ in 0..most bits of a group: a Poisson-binomial over the bits, each less
    likely to differ by its squared correlation with the nearest bit before it."""
    p = np.diag(both) / max(n, 1)
    share = [1.0] + [0.0] * most
    for i, b in enumerate(group):
        r2 = 0.0
        for c in group[:i]:
            var = p[b] * (1 - p[b]) * p[c] * (1 - p[c])
            r2 = max(r2, (both[b, c] / max(n, 1) - p[b] * p[c]) ** 2 / var if var > 0 else 1.0)
        d = 2 * p[b] * (1 - p[b]) * (1 - min(r2, 1.0))
        share = [share[0] * (1 - d)] + [share[k] * (1 - d) + share[k - 1] * d for k in range(1, most + 1)]
    return share


def allot(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Least sum of costs[i][u_i] with sum u_i = budget; u_i = t_i + 1, 0 leaves partition i out."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * budget
    for row in costs:
        best = [min(((best[s - u][0] + c, [*best[s - u][1], u]) for u, c in enumerate(row) if u <= s), default=(math.inf, [])) for s in range(budget + 1)]
    return best[budget]


def plan(n: int, both: np.ndarray, distance: int, most: int = 2) -> list[int]:
    """Masks whose equal results make two fingerprints candidates; every pair within distance shares one at least."""
    found = None
    for m in range(2, min(distance + 3, 12) + 1):
        groups, costs = partitions(n, both, m), []
        for g in groups:
            share = distance_shares(n, both, g, most)
            costs.append([0.0] + [n * math.comb(len(g), t) * PROBE_COST + n * n / 2 * PAIR_COST * sum(share[j] * math.comb(len(g) - j, t - j) for j in range(t + 1)) for t in range(most + 1) if t < len(g)])
        cost, units = allot(costs, distance + 1)
        if units and math.isfinite(cost) and (found is None or cost < found[0]):
            found = (cost, groups, units)
    return [sum(1 << b for b in g if b not in off) for g, u in zip(*found[1:], strict=True) if u for off in combinations(g, u - 1)]


# ---- links


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def forest(group: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that span the links within runs of equal group; rows of a group are adjacent."""
    n = len(group)
    label = np.arange(n)
    ends = np.searchsorted(group, group, "right")
    left, right, i, off = [], [], np.arange(n), 1
    while len(i := i[i + off < ends[i]]):
        j = i + off
        ok = label[i] != label[j]
        a, b = i[ok], j[ok]
        ok = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
            lx, ly = label[x], label[y]
            if lx != ly:
                left.append(x)
                right.append(y)
                lo = np.searchsorted(group, group[x])
                own = label[lo : ends[x]]
                own[own == max(lx, ly)] = min(lx, ly)
        off += 1
    return np.array(left, np.int64), np.array(right, np.int64)


def nearest(group: np.ndarray, part: np.ndarray, judge, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row with its most nearest candidates in runs of equal group that are of another part; judge(i, j) gives the
    positions of the row pairs that are candidates, and their distances.

    A row that may have more is paired with itself besides, so a pair left out has both its rows marked.
    """
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not len(group):
        return lefts[0], rights[0]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    open_ = np.minimum.reduceat(part, first) < np.maximum.reduceat(part, first)  # groups of one part have no pairs left
    sizes, first = np.diff(np.append(first, len(group)))[open_], first[open_]
    pairs = np.cumsum(sizes * (sizes - 1) / 2)
    g = 0
    while g < len(sizes):
        until = max(g + 1, int(np.searchsorted(pairs, (pairs[g - 1] if g else 0) + PAIRS, "right")))
        counts = sizes[g:until]
        ends = np.repeat(first[g:until] + counts, counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[g:until], counts)
        i, off, found = rows, 1, []
        while len(i):
            inside = i + off < ends
            i, ends = i[inside], ends[inside]
            j = i + off
            other = np.flatnonzero(part[i] != part[j])
            ok, by = judge(i[other], j[other])
            found.append(np.stack([i[other][ok], j[other][ok], by]))
            off += 1
        if found:
            a, b, d = np.concatenate(found, axis=1)
            a, b, d = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([d, d])
            order = np.lexsort((b, d, a))
            a, b = a[order], b[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            more = np.unique(a[rank >= most])
            lefts += [a[rank < most], more]
            rights += [b[rank < most], more]
        g = until
    return np.concatenate(lefts), np.concatenate(rights)


def compared(nodes: DataFrame, distance: int, kernel) -> DataFrame:
    """Pairs (a, b) of the nodes(node, fp) that kernel(group, rows) picks from buckets of equal probes."""
    n, both = bit_statistics(nodes)
    masks = plan(n, both, distance)
    probes = nodes.select("node", "fp").withColumn("probe", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bits")) for k, m in enumerate(masks)]))).select("node", "fp", "probe.k", "probe.bits")
    sizes = probes.groupBy("k", "bits").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > BLOCK)
    hot = common.written(sizes.select("k", "bits", F.lit(0).alias("main_blocks"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "hot")
    return picked(probes, hot, F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"), ["node", "fp"], ["fp"], kernel)


def picked(probes: DataFrame, hot: DataFrame, block: Column, row: list[str], order: list[str], kernel) -> DataFrame:
    """Pairs (a, b) of the probes(k, bits and the columns row, node among them) that kernel(group, rows) picks from
    buckets of equal k and bits; order: the columns of row that decide its place in a bucket.

    The buckets in hot(k, bits, main_blocks, blocks) are cut: block tells each row's, and each pair of blocks is a group
    of its own but those of two of the first main_blocks.
    """
    if hot.isEmpty():
        placed = probes.withColumns({"x": F.lit(0), "y": F.lit(0)})
    else:
        others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (j != F.col("b")) & (F.greatest(j, F.col("b")) >= F.col("main_blocks")))
        placed = probes.join(hot, ["k", "bits"], "left").withColumn("b", block).withColumn("o", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(others)))
        placed = placed.withColumns({"x": F.when(F.col("blocks").isNull(), 0).otherwise(F.least("b", "o")), "y": F.when(F.col("blocks").isNull(), 0).otherwise(F.greatest("b", "o"))})
    placed = placed.select(*row, "k", "bits", "x", "y").repartition("k", "bits", "x", "y").sortWithinPartitions("k", "bits", "x", "y", *order)

    def run(batches: Iterator[pd.DataFrame]):
        held: list[pd.DataFrame] = []
        size = 0

        def work(all_rows: pd.DataFrame, final: bool):
            keys = [all_rows[c].to_numpy() for c in ("k", "bits", "x", "y")]
            new = np.zeros(len(all_rows), bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            group = np.cumsum(new)
            upto = len(all_rows) if final else int(np.searchsorted(group, group[-1]))
            a, b = kernel(group[:upto], all_rows.iloc[:upto])
            ids = all_rows["node"].to_numpy()
            pairs = np.unique(np.sort(np.stack([ids[a], ids[b]], 1), axis=1), axis=0)
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}), all_rows.iloc[upto:]

        for b in batches:
            held.append(b)
            size += len(b)
            if size >= CHUNK:
                out, rest = work(pd.concat(held), False)
                held, size = [rest], len(rest)
                yield out
        if size:
            yield work(pd.concat(held), True)[0]

    return placed.mapInPandas(run, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that connect the nodes(node, fp) within distance just as all their links would."""
    return compared(nodes, distance, lambda group, rows: forest(group, unsigned(rows["fp"]), distance))


# ---- groups by similarity


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The docs(doc_id, text) whose doc_id is among ids(doc_id), which is written and has no repeats."""
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    return common.id_text(docs).join(ids, "doc_id", "left_semi")


def allowed(edges: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """The edges(a, b) but those whose sketches rule a similarity of least out; prints has doc_id, n and sketch."""
    of = lambda x: prints.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))

    def run(batches):
        for b in batches:
            c = {k: b.column(k).to_pylist() for k in ("na", "nb", "sa", "sb")}
            ok = [parities_differ(x, y) * (1 + least) <= (m + n) * (1 - least) * (1 + 1e-9) for m, n, x, y in zip(*c.values(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return edges.join(of("a"), "a").join(of("b"), "b").mapInArrow(run, "a long, b long").distinct()


def similar(edges: DataFrame, prints: DataFrame, docs: DataFrame, size: int, least: float) -> DataFrame:
    """The edges(a, b) whose texts' sets of shingles of size words have a Jaccard similarity of least or more.

    Every a goes to where its b is, so an edge moves one text; the texts of one b are shared out among tasks.
    """
    common.arrow(docs.sparkSession)
    edges = common.written(allowed(edges, prints, least), "allowed")
    ids = common.written(edges.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    texts = common.written(texts_of(docs, ids), "texts")
    shares = common.written(edges.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PARTNERS_PER_TASK).cast("int").alias("shares")), "shares")
    dealt = common.written(edges.join(shares, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share")), "dealt")
    each = dealt.join(texts.withColumnRenamed("doc_id", "a"), "a").select("b", "share", "a", "text")
    center = shares.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).join(texts.withColumnRenamed("doc_id", "b"), "b").select("b", "share", F.lit(None).cast("long").alias("a"), "text")
    rows = each.unionByName(center).repartition("b", "share").sortWithinPartitions("b", "share", F.asc_nulls_first("a"))

    def run(batches):
        own = None  # the set of b, whose row comes first
        for batch in batches:
            found = []
            for a, b, s in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), shingle_sets(batch.column("text"), size), strict=True):
                if a is None:
                    own = s
                else:
                    shared = len(np.intersect1d(own, s, assume_unique=True))
                    if shared >= least * (len(own) + len(s) - shared):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def bound(least: float, n: tuple[str, str], parity: tuple[str, str]) -> Column:
    """As similarity_bound, over columns: sizes, and prefixes of the names of the parities."""
    apart = sum((F.bit_count(F.col(parity[0] + c).bitwiseXOR(F.col(parity[1] + c))) for c in PARITY), F.lit(0))
    differ = F.greatest(apart.cast("long"), F.abs(F.col(n[0]) - F.col(n[1])))
    return differ * (1 + least) <= (F.col(n[0]) + F.col(n[1])) * ((1 - least) * (1 + 1e-9))


def to_leaders(probes: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """For each node of the probes(bits, node) that may be similar to the first node of one of its buckets, the pair
    (a, b) with the one that it shares most buckets with."""
    first = common.written(probes.groupBy("bits").agg(F.min("node").alias("b")), "first")
    pairs = probes.join(first, "bits").filter("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("shared"))
    sizes = nodes.select("node", "n", *PARITY)
    names = lambda x: sizes.select(F.col("node").alias(x), *(F.col(c).alias(x + c) for c in ("n", *PARITY)))
    may = common.written(pairs, "leaders").join(names("a"), "a").join(names("b"), "b").filter(bound(least, ("an", "bn"), ("a", "b")))
    return may.groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))


def open_probes(probes: DataFrame, active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The probes(bits, node) of active(node, part, ...) nodes, with active's columns and k, whose bucket has nodes of
    several parts; and how buckets of over BLOCK rows are cut: the rows of the commonest part come first and need not
    be compared with each other."""
    rows = common.written(probes.join(active.select("node", "part"), "node"), "rows")
    parts = rows.groupBy("bits", "part").agg(F.count(F.lit(1)).alias("c"))
    buckets = parts.groupBy("bits").agg(F.sum("c").alias("rows"), F.max(F.struct("c", "part")).alias("m")).filter(F.col("rows") > F.col("m.c"))
    buckets = common.written(buckets.select("bits", "rows", F.col("m.c").alias("main_rows"), F.col("m.part").alias("main")), "buckets")
    rows = common.written(rows.select("bits", "node").join(buckets.select("bits"), "bits", "left_semi"), "rows")
    main = F.ceil(F.col("main_rows") / BLOCK).cast("int")
    rest = F.ceil((F.col("rows") - F.col("main_rows")) / BLOCK).cast("int")
    hot = common.written(buckets.filter(F.col("rows") > BLOCK).select(F.lit(0).alias("k"), "bits", "main", main.alias("main_blocks"), (main + rest).alias("blocks")), "hot")
    return rows.join(active, "node").withColumn("k", F.lit(0)), hot


def candidates(probes: DataFrame, active: DataFrame, least: float, most: int) -> DataFrame:
    """Of each node in active(node, part, digest, n, PARITY) most candidates of other parts, the nearest in parity, and
    the node with itself if it may have more."""
    rows, hot = open_probes(probes, active)

    def kernel(group, rows):
        may, parity = similarity_bound(rows, least), rows[PARITY].to_numpy(np.int64).view(np.uint64)

        def judge(i, j):
            ok = np.flatnonzero(may(i, j))
            return ok, np.bitwise_count(parity[i[ok]] ^ parity[j[ok]]).sum(1, dtype=np.int64)

        return nearest(group, rows["part"].to_numpy(), judge, most)

    digest = F.xxhash64("digest")
    block = F.when(F.col("part") == F.col("main"), F.pmod(digest, F.col("main_blocks"))).otherwise(F.col("main_blocks") + F.pmod(digest, F.col("blocks") - F.col("main_blocks"))).cast("int")
    return picked(rows, hot, block, active.columns, ["n", "digest"], kernel)


def set_links(nodes: DataFrame, prints: DataFrame, docs: DataFrame, size: int, least: float) -> DataFrame:
    """Edges (a, b), stars, that connect the nodes(node, digest, n, PARITY, fp) as all pairs of similarity least or more
    would."""
    mine = prints.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    mine = common.written(mine.select(F.col("doc_id").alias("node"), "plain", "frequent"), "prefixes")
    # hashes that are not frequent make no large window; those that a node is alone with, most of them, are not written
    alone = F.count(F.lit(1)).over(Window.partitionBy("bits"))
    plain = mine.select("node", F.explode("plain").alias("bits")).withColumn("c", alone).filter("c > 1").select("bits", "node")
    probes = common.written(plain.unionByName(mine.select(F.explode("frequent").alias("bits"), "node")), "probes")
    by_print = common.written(nodes.groupBy("fp").agg(F.min("node").alias("b")), "fingerprints")
    equal = nodes.join(by_print, "fp").select(F.col("node").alias("a"), "b").filter("a <> b")
    near = links(by_print.select(F.col("b").alias("node"), "fp"), NEAR_BITS).select(F.col("b").alias("a"), F.col("a").alias("b"))
    tried = common.written(equal.unionByName(near).unionByName(to_leaders(probes, nodes, least)).distinct(), "tried")
    edges = common.written(similar(tried, prints, docs, size, least), "links")
    active = nodes.select("node", "digest", "n", *PARITY)
    parts = components.components(edges)
    for most in (*PARTNERS, 1 << 62):
        parted = common.written(active.join(parts, "node", "left").select(*active.columns, F.coalesce("component", "node").alias("part")), "active")
        found = common.written(candidates(probes, parted, least, most), "candidates")
        ends = (F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
        new = common.written(found.filter("a <> b").select(*ends).join(tried.select(*ends).distinct(), ["a", "b"], "left_anti"), "new")
        if not new.isEmpty():
            tried = tried.unionByName(new)
            more = common.written(similar(new, prints, docs, size, least), "links")
            if not more.isEmpty():
                # the components so far are stars, which the new links join
                edges = common.written(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "edges")
                parts = components.components(edges)
        active = common.written(active.join(found.filter("a = b").select(F.col("a").alias("node")), "node", "left_semi"), "active")
        if active.isEmpty():
            break
    return parts.select(F.col("node").alias("a"), F.col("component").alias("b"))


def common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """The buckets of hashes (their low bits) with frequent shingles, by falling count. All docs(text) are counted, each
    of them once for a shingle, in one table of counts a task, whose parts are added up."""
    least = COMMON_COUNT * max(1.0, docs.count() / ORDER_DOCS)

    def run(batches):
        counts = np.zeros(BUCKETS, np.int32)
        for b in batches:
            for s in shingle_sets(b.column("text"), size):
                np.add.at(counts, (s & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        for at in range(0, BUCKETS, 64 * COUNTS):
            ks = range(at, min(at + 64 * COUNTS, BUCKETS), COUNTS)
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array([counts[k : k + COUNTS].tobytes() for k in ks], pa.binary())], ["k", "counts"])

    def add(p: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(COUNTS, np.int64)
        for c in p["counts"]:
            total += np.frombuffer(c, np.int32)
        found = np.flatnonzero(total >= least)
        return pd.DataFrame({"bits": found + p["k"].iloc[0], "c": total[found]})

    found = docs.select("text").mapInArrow(run, "k long, counts binary").groupBy("k").applyInPandas(add, "bits long, c long").toPandas()
    return found.sort_values(["c", "bits"], ascending=[False, True])["bits"].to_numpy(np.int64).view(np.uint64)


def prefix(s: np.ndarray, known: np.ndarray, rank: np.ndarray, least: float, bits: int = (1 << 64) - 1) -> tuple[np.ndarray, np.ndarray]:
    """The first n - ceil(least n) + 1 of the different hashes s in an order of all hashes, those whose bits are not
    known (sorted) first, then by falling rank; and which of them are known."""
    order = np.full(len(s), len(known))
    if len(known) and len(s):
        own = s & np.uint64(bits)
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        order = np.where(known[at] == own, rank[at], order)
    first = np.lexsort((s, -order))[: len(s) - math.ceil(least * len(s) - 1e-9) + 1]
    return s[first], order[first] < len(known)


def grouped(prints: DataFrame, find, keys: list[str]) -> DataFrame:
    """doc_id, the keys, component_id of prints(doc_id, keys); rows of equal keys are one node; find: takes
    nodes(node, keys), returns edges."""
    nodes = common.written(prints.groupBy(*keys).agg(F.min("doc_id").alias("node")), "nodes")
    found = components.components(find(nodes.filter("node is not null")))
    classes = nodes.join(found, "node", "left").select(*keys, F.coalesce("component", "node").alias("component_id"))
    return prints.select("doc_id", *keys).join(common.written(classes, "classes"), keys)


def near_dedup(docs: DataFrame, size: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of docs(doc_id, text).

    Null and empty texts and texts without words have fingerprint zero and link as any other. component_id is the
    smallest doc_id that links reach, itself included; null ids are passed over, and a component of null ids only has
    none. Rows that repeat a doc_id link each by its own fingerprint. An empty table gives an empty result; other
    columns are ignored.
    """
    prints = common.written(fingerprints(docs, size), "prints")
    found = grouped(prints, lambda nodes: links(nodes, distance), ["fp"])
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def similar_groups(docs: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id, component_id of docs(doc_id, text) grouped by Jaccard similarity of their sets of word shingles.

    Links of near fingerprints are checked exactly; a prefix filter gives all other pairs of similarity least or more
    as candidates. Every candidate pair is checked exactly, but those of one component already and those whose sizes or
    parities rule it out. Texts of one set of shingles (by digest and size) are one node. Rows without a doc_id are in
    no group but that of an equal set. Rows that repeat a doc_id have to have one text. See near_dedup for the rest.
    """
    prints = common.written(set_prints(docs, size, least), "prints")
    keys = ["digest", "n", *PARITY, "fp"]
    return grouped(prints, lambda nodes: set_links(nodes, prints, docs, size, least), keys).select("doc_id", "component_id")
