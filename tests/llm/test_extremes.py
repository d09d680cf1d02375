"""Extreme inputs and plain re-statements: collisions, very long texts, crowds of copies, overlapping detections."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandloom.llm import decontamination, exact_dedup, langid, licenses, mixing, secrets, simhash, substring_dedup, tokens, url_filter, words


# ---- language


def test_a_language_is_trained_whose_rows_are_mostly_copies(spark):
    french = "le chat et le chien sont dans la maison avec eux pour la nuit de noel"
    rows = [(i, "the cat and the dog are in the house with them", "en") for i in range(20000)]
    rows += [(30000 + i, f"{french} {french[i % 30:]} numero {i}", "fr") for i in range(300)] + [(40000, "12345 ----------- " * 100 + "das haus", "de")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(d)
    assert model.langs == ["de", "en", "fr"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(d.filter("doc_id in (0, 30001, 30007)"), model).collect()}
    assert got == {0: "en", 30001: "fr", 30007: "fr"}


def test_predictor_is_a_plain_convolution():
    rng = np.random.default_rng(0)
    windows = rng.integers(1, 255, (40, langid.WINDOW)).astype(np.uint8)
    windows[3, 20:] = 0
    model = langid.train(windows, rng.integers(0, 3, 40), ["a", "b", "c"], epochs=1)
    got = langid.Predictor(model).windows(windows)
    for w, row in zip(windows, got, strict=True):
        x = model.symbol[words.LOWER[w]]
        h = []
        for width, kernel in zip(langid.WIDTHS, model.kernels, strict=True):
            for f in range(langid.FILTERS):
                h.append(max(sum(float(kernel[k][x[i + k]][f]) for k in range(width)) for i in range(langid.WINDOW - width + 1)))
        z = np.maximum(np.array(h) + model.bias, 0) @ model.out + model.out_bias
        assert row == pytest.approx(np.exp(z) / np.exp(z).sum(), abs=1e-4)


# ---- secrets


def least_cost(value):
    """Over all cuts of the value, with each part's cost from its description."""
    n, rank = len(value), {w: i + 1 for i, w in enumerate(dict.fromkeys(secrets.WORDS))}
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value)

    def part(i, j):
        s, word = value[i:j], low[i:j]
        costs = [sum(math.log10(secrets.alphabet(c)) for c in s)]
        case = 0 if s == word else math.log10(2) if s in (word.upper(), word.capitalize()) else len(s) * math.log10(2)
        meant = word.translate(str.maketrans("4@3!10$57", "aaeiiosst"))
        if word in rank:
            costs.append(math.log10(rank[word]) + case)
        if meant != word and meant in rank:
            costs.append(math.log10(rank[meant]) + math.log10(4) + case)
        if secrets.DATE.fullmatch(s):
            costs.append(math.log10(365 * 130))
        if len(s) >= 3 and all(p in secrets.NEXT for p in zip(word, word[1:], strict=False)):
            costs.append(math.log10(47 * 4) + math.log10(n))
        for u in (1, 2, 3, 4):
            if len(s) >= max(3, 2 * u) and s == s[:u] * (len(s) // u):
                costs.append(sum(math.log10(secrets.alphabet(c)) for c in s[:u]) + math.log10(n))
        return min(costs) + math.log10(5)

    best = [0.0]
    for j in range(1, n + 1):
        best.append(min(best[i] + part(i, j) for i in range(j)))
    return best[n]


def test_guess_cost_is_the_least_of_all_cuts():
    r = random.Random(1)
    pieces = ["password", "P4ss", "qwer", "asdfg", "aaa", "abab", "xyzxyz", "2019", "07051999", "Dragon", "zz", "1", "!", "k9#", "ASDF", "abcdabcdabcd", "111111", "\u00e9"]
    for _ in range(1500):
        value = "".join(r.choice(pieces) if r.random() < 0.7 else r.choice("aAbB1920-/.qwe") for _ in range(r.randint(1, 6)))
        assert secrets.log_guesses(value) == pytest.approx(least_cost(value), abs=1e-9), value


def test_base_spans_by_plain_patterns():
    r = random.Random(2)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", " = ", ": ", '"', "'", "=", "hunter2hunter", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "abc", " ", "x", "=="]
    want = {"assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8), "access": r"(AKIA[A-Z0-9]+)", "hex": r"([0-9a-f]+)"}
    least = {"assign": 8, "access": 16, "hex": 32}
    for _ in range(800):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 14)))
        plain = set()
        for kind, p in want.items():
            for m in re.finditer(p[0] if isinstance(p, tuple) else p, text):
                if len(m[1]) >= least[kind]:
                    plain.add((kind, *m.span()))
        assert {x[:3] for x in secrets.scan(text) if x[0] != "guess"} == plain, text


@pytest.mark.parametrize("text", ["x" * 1_000_000, "a://" * 250_000, "abc def://x:y " * 70_000, 'password: "' + "a " * 400_000, "pin:' " * 150_000])
def test_secret_scan_is_linear(text):
    began = time.process_time()
    secrets.scan(text)
    assert time.process_time() - began < 8


def test_dictionary_takes_a_vocabulary():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert secrets.log_guesses("correct zebra battery staple", path) < secrets.log_guesses("correct zebra battery staple") - 8


# ---- exact dedup


def test_exact_dedup_by_join_and_by_broadcast(spark, monkeypatch):
    rows = [(i, f"text {i % 7}" if i % 3 else "hot") for i in range(200)] + [(None, "hot"), (None, None), (7, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, exact_dedup.exact_dedup(d).collect()))
    monkeypatch.setattr(exact_dedup, "SENT_DIGESTS", 0)
    assert got == sorted(map(str, exact_dedup.exact_dedup(d).collect())) and len(got) == len(rows)


def test_pipeline_exact_stage_keeps_every_text_once(spark, tmp_path):
    import corpus_pipeline

    d = spark.createDataFrame([(5, "alpha beta"), (5, "gamma delta"), (7, "alpha beta")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.exact(spark, d, str(tmp_path)).collect()) == [(5, "gamma delta"), (7, "alpha beta")]


# ---- licenses


def test_stay_equals_a_double_loop():
    r = random.Random(3)
    for _ in range(400):
        found = sorted({licenses.Detection(f"l{r.randint(0, 3)}", a := r.randint(0, 12), a + r.randint(1, 8), r.randint(0, 2), 0.5, r.randint(0, 9)) for _ in range(r.randint(0, 14))})

        def wins(y, x):  # y makes x go
            inside = y.start <= x.start and x.end <= y.end
            if not inside or y.priority < x.priority or x == y:
                return False
            if (y.start, y.end, y.priority) == (x.start, x.end, x.priority):
                return (y.rule, found.index(y)) < (x.rule, found.index(x))
            return True

        assert licenses.stay(found) == [x for x in found if not any(wins(y, x) for y in found)]


def test_license_priorities():
    labels = lambda t: licenses.scan(t)[5].split(",")
    assert labels("licensed under the Apache License, Version 2.0") == ["apache", "apache-2.0"]  # the base label is always there
    assert labels("released under the mozilla public license 2.0") == ["mpl-2.0"]
    assert labels("the Mozilla Public License") == ["mpl"]
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == ["bsd-3-clause"]


@pytest.mark.parametrize("text", ["cc by " * 8000, "licensed under the mit license " * 4000, "license " * 50_000, "under the " * 50_000, "x " * 400_000])
def test_license_scan_is_linear(text):
    began = time.process_time()
    licenses.scan(text)
    assert time.process_time() - began < 8


# ---- tokens


def test_token_counts_of_extreme_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, count = Tokenizer.from_file(path), tokens.counter(path)
    for t in (" " * 2_000_000, "\n" * 1_200_000, "a" * 1_000_000, "x " + " \n" * 600_000 + "y"):
        assert count([t, "z"]) == [len(own.encode(t, add_special_tokens=False).ids), 1]


def test_token_counts_of_a_whole_table(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, d = Tokenizer.from_file(path), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in d.collect()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in tokens.token_counts(d, path, str(tmp_path / "cache")).collect()}
    assert got == {k: (len(t.encode()), len(own.encode(t, add_special_tokens=False).ids)) for k, t in texts.items()}


# ---- repeated passages


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_words_of_a_known_collision_differ(spark):
    a = "".join("ab"[x] for x in thue_morse(1024))
    b = "".join("ba"[x] for x in thue_morse(1024))
    raw = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    starts, ends, _ = words.words(raw, np.array([0, len(raw)]))
    h = words.word_hashes(raw, starts, ends)
    assert h[0] == h[2] != h[1]
    text = lambda w: " ".join([*(f"l{i}" for i in range(30)), w, *(f"r{i}" for i in range(30))])
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(spark.createDataFrame([(1, text(a)), (2, text(b)), (3, text(a))], "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 61}


def test_equal_hashes_of_windows_remove_nothing(spark, monkeypatch):
    """Windows are removed for their words, not for their hashes: with a hash that always collides all is as before."""
    r = random.Random(4)
    shared = [f"s{i}" for i in range(70)]
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(r.randint(0, 80))] + shared[: r.randint(0, 70)] + [f"b{i}x{k}" for k in range(40)])) for i in range(12)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    first, want = {}, {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for i, t in rows:
        w = t.split()
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(50)}
        want[i] = (len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    result = lambda: {x["doc_id"]: (x["n_removed"], x["kept_sha256"]) for x in substring_dedup.substring_dedup(d).collect()}
    assert result() == want
    monkeypatch.setattr(substring_dedup, "anchors", lambda h, first, window, gram: collide(first, window))
    assert result() == want


def collide(first, window):
    counts = np.maximum(np.diff(first) - window + 1, 0)
    return np.full(counts.sum(), 7, np.uint64), np.concatenate([[0], np.cumsum(counts)])


# ---- shingle sets


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(6)
    known = np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64))
    rank = rng.permutation(len(known))
    for _ in range(300):
        n = int(rng.integers(1, 60))
        base = np.unique(np.concatenate([rng.integers(0, 2**63, n, dtype=np.uint64), rng.choice(known, int(rng.integers(0, 20)))]))
        other = np.unique(np.concatenate([base[int(len(base) * rng.random() * 0.2) :], rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        shared = len(np.intersect1d(base, other))
        if shared >= 0.8 * (len(base) + len(other) - shared):
            p, q = simhash.prefix(base, known, rank, 0.8), simhash.prefix(other, known, rank, 0.8)
            assert len(np.intersect1d(p[0], q[0])) and (p[1] == np.isin(p[0], known)).all()


def test_common_shingles_are_counted_in_every_document(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ORDER_DOCS", 10)
    texts = [f"own{i} a b c d e " + "f g h i j " * (i % 3 == 0) + "k l m n o p " * (i % 6 == 0) + f"end{i}" for i in range(60)] + [""]
    counts = {}
    for s in simhash.shingle_sets(pa.array(texts), 5):
        for b in {h & (simhash.BUCKETS - 1) for h in s.tolist()}:
            counts[b] = counts.get(b, 0) + 1
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    for least in (1.6, 3):  # of 10 documents
        monkeypatch.setattr(simhash, "COMMON_COUNT", least)
        want = {b: n for b, n in counts.items() if n >= least * 6.1}
        got = simhash.common_shingles(docs, 5).tolist()
        assert set(got) == set(want) and len(got) == len(want) and [want[b] for b in got] == sorted(want.values(), reverse=True)


def test_parities_rule_no_similar_pair_out():
    rng = np.random.default_rng(8)
    out = 0
    for n in (1, 30, 400, 3000):
        for cut in (0, 0.05, 0.1, 0.11, 0.2, 0.4, 1):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[int(len(a) * cut) :], rng.integers(0, 2**63, int(n * cut * rng.random()), dtype=np.uint64)]))
            size = lambda s: simhash.parities(s, 1 << max(9, (2 * len(s) - 1).bit_length())).tobytes()
            differ, shared = simhash.parities_differ(size(a), size(b)), len(np.intersect1d(a, b))
            assert differ <= len(a) + len(b) - 2 * shared
            out += differ * 1.8 > (len(a) + len(b)) * 0.2
    assert out > 8


def test_shingle_sets_of_text_columns():
    col = pa.array(["A b c d e f", "", "one two", "a b c d e f g"])
    sizes = [len(s) for s in simhash.shingle_sets(col, 5)]
    assert sizes == [2, 0, 1, 3]


# ---- decontamination


def test_decontamination_finds_what_the_check_accepts_anywhere(spark):
    """Against the final check on every pair of a whole text and an item, with no zones and no cosines."""
    rng = np.random.default_rng(9)
    vocab = [f"v{i}" for i in rng.zipf(1.4, 4000) % 1500]
    items = [(i, " ".join(rng.choice(vocab, int(n)))) for i, n in enumerate(rng.integers(3, 90, 60))]
    rows = []
    for d in range(300):
        w = rng.choice(vocab, int(rng.integers(0, 300))).tolist()
        if d % 2:
            item = items[int(rng.integers(60))][1].split()
            share = (0.0, 0.1, 0.2, 0.3, 0.38, 0.5)[d // 2 % 6]  # of its words are other ones
            w[len(w) // 2 : len(w) // 2] = [x if rng.random() >= share else f"z{k}" for k, x in enumerate(item)]
        rows.append((d, " ".join(w)))
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ix = next(decontamination.searches(d, b)).__defaults__[0].value
    want = {i for i, t in rows if any(decontamination.verdict(item, decontamination.text_hashes(t))[1] for item in ix.items)}
    got = {r["doc_id"] for r in decontamination.decontaminate(d, b).collect() if r["contaminated"]}
    # where a stretch begins, and the cosine, make a difference to texts on the edge
    assert len(got & want) >= 0.94 * len(want) and len(got - want) <= 0.02 * len(want) and 100 < len(want) < 300
    kept = sorted(r["doc_id"] for r in decontamination.keep_clean(d, b).collect())
    assert kept == sorted({i for i, _ in rows} - got)


def test_product_is_a_plain_matrix_product(spark):
    rng = np.random.default_rng(1)
    idf = rng.random(decontamination.FEATURES).astype(np.float32)
    rows = [(rng.integers(0, decontamination.FEATURES, 30).tolist(), float(w)) for w in (1, 1, 2.5, 4, 0.5)]
    a = np.stack([np.bincount(f, minlength=decontamination.FEATURES) * idf for f, _ in rows])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    x = rng.normal(size=(decontamination.FEATURES, 3)).astype(np.float32)
    got = decontamination.product(spark.createDataFrame(rows, "f array<int>, w double").repartition(3), idf, x)
    assert got == pytest.approx(a.T @ (np.array([[w] for _, w in rows]) * (a @ x)), abs=1e-3)


def test_the_latent_space_rests_on_every_document(spark, monkeypatch):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), F.when(F.col("id") % 1000 > 0, F.col("id"))).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(-1, ""), (-2, None), (-3, "long " * 100_000)], "doc_id long, text string"))
    items = spark.createDataFrame([(1, "some words of an item"), (2, None)], "item_id long, text string")
    seen, plain = [], decontamination.product
    monkeypatch.setattr(decontamination, "product", lambda rows, *a: seen.append(rows.selectExpr("count(*) n", "sum(size(f)) words").first()) or plain(rows, *a))
    next(decontamination.searches(docs, items))
    assert [tuple(x) for x in seen] == [(30_002, 2 * 29_970 + 30 + 100_000 + 5)] * 2  # documents with words, and one item


# ---- mixing


def test_the_draw_is_a_sort_and_a_prefix_sum(spark, monkeypatch):
    """By each source's keys in order: whole epochs, then documents as long as they fit, then the one nearest to the gap."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    r = random.Random(5)
    rows = [(i, "word " * r.randint(0, 40) + "1% " * r.randint(0, 20), r.choice("abbbbbc") if r.random() < 0.9 else None) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keys = {x["doc_id"]: (x["source"], x["size"], x["key"]) for x in mixing.drawn(d, 17).collect()}
    got = {x["doc_id"]: (x["target"], x["taken"]) for x in mixing.mix(d, seed=17).collect()}
    for source in {k[0] for k in keys.values()}:
        ids = sorted((i for i in keys if keys[i][0] == source), key=lambda i: (keys[i][2], i))
        total, target = sum(keys[i][1] for i in ids), got[ids[0]][0]
        epochs = int(target // total)
        rest, picked, last = target - epochs * total, set(), None
        for i in ids:
            size = keys[i][1]
            if sum(keys[j][1] for j in picked) + size <= rest and last is None:
                picked.add(i)
            else:
                last = last or i
        gap = rest - sum(keys[i][1] for i in picked)
        taken = sum(got[i][1] for i in ids)
        assert {i for i in picked if keys[i][1]} <= {i for i in ids if got[i][1] == (epochs + 1) * keys[i][1]}
        extra = [i for i in ids if got[i][1] == (epochs + 1) * keys[i][1] and keys[i][1] and i not in picked]
        assert len(extra) <= 1 and abs(taken - target) <= gap + 1e-6
        assert all(got[i][1] in (epochs * keys[i][1], (epochs + 1) * keys[i][1]) for i in ids)


def test_quality_weighs_the_draw(spark):
    rows = [(i, "plain words here" if i % 2 else "1% 2% 3%", "a") for i in range(4000)] + [(9000 + i, "x " * 3, "b") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5).filter("doc_id < 9000 and taken > 0").collect()
    plain = sum(x["doc_id"] % 2 for x in got)
    assert plain > 1.5 * (len(got) - plain)


# ---- lists


def test_url_filter_repeats(spark):
    e = spark.createDataFrame([("bad.com", "x", "2024-01-10", True)], "list_key string, category string, day string, listed boolean")
    c = spark.createDataFrame([(1, "http://bad.com/", "2024-02-01")] * 3 + [(None, "http://bad.com/", "2024-02-01"), (2, "", None)], "page_id long, url string, fetched_on string")
    got = url_filter.url_filter(c, e).collect()
    assert len(got) == 5 and sum(x["blocked"] for x in got) == 4


# ---- the pipeline


def test_stages_bear_any_table(spark, tmp_path):
    """Nulls in every column, clashing names, repeats and empty tables."""
    import corpus_pipeline

    sf = str(tmp_path)
    spark.createDataFrame([(1, "some benchmark item of ten words that is quite long")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    text = "the house and the garden are in the town with the river and all the people there"
    rows = [(None,) * 9, (1, text, "en", "a", 5, 1, 1, "x", 0.5), (1, text, "en", "a", 5, 1, 1, "x", 0.5), (2, None, None, None, None, None, None, None, None), (3, "", "en", "", 0, 2, 2, "", 1.0), (None, text + " more", "en", "a", 5, 1, 1, "x", 0.5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, a long, b long, digest string, score double"
    for i, d in enumerate((spark.createDataFrame(rows, schema), spark.createDataFrame([], schema))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, sf)
            kept = out.collect()
            assert name == "mixing" or out.columns == d.columns
            if i:
                assert not kept
            elif name == "language":
                assert [x["text"] for x in kept].count(text) == 2 and len(kept) == 3
            elif name == "exact_dedup":
                assert sorted(x["text"] or "" for x in kept) == ["", text, text + " more"]
            elif name in ("decontamination", "mixing"):
                assert len(kept) == len(rows)
