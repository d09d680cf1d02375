"""Token counts through a digest cache.

The cache is a Parquet folder of (text_digest, tokenizer_digest, n_tokens). Rows are joined to it by the digests of the
text and of the tokenizer file, only different texts without an entry are encoded, and their counts are appended.
Texts are normalised for the digest by taking null as empty and nothing else, as any other change could alter a count.
"""

from __future__ import annotations

import functools
import hashlib
import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CACHE_SCHEMA = "text_digest binary, tokenizer_digest string, n_tokens long"
PROBES = ("", " ", "it's  a\n\ntest 123 <|endoftext|> and 'Re\u00e9l \u4e2d\u6587 \u0663\u00bd\u200d\U0001f600\t x\u00a0y\u3000z\x85 end  ")


@functools.lru_cache(4)
def counter(path: str):
    """A function from a list of texts to their token counts, equal to those of the file's own library.

    A byte-level BPE without normaliser whose ids follow its merges is counted by tiktoken from the same file's
    vocabulary, six times as fast; it must agree with the tokenizers library on PROBES, else that library counts. It
    also counts each text that tiktoken refuses, such as one with a million blanks in a row.
    """
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_padding()
    own.no_truncation()
    slow = lambda texts: [len(own.encode(x, add_special_tokens=False).ids) for x in texts]
    d = json.loads(Path(path).read_text())
    pre, model = d.get("pre_tokenizer") or {}, d["model"]
    if d.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or model["type"] != "BPE" or model.get("ignore_merges"):
        return slow
    if not all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in d["added_tokens"]):
        return slow
    vocab, merged = model["vocab"], ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocab[t] for t in merged]
    special = {t["content"]: t["id"] for t in d["added_tokens"]}
    # tiktoken merges by rank, which is the id here: the two orders have to be one
    if ids != sorted(set(ids)) or {*vocab} - {*merged} - {*special} != {c for c in vocab if len(c) == 1 and c not in special}:
        return slow
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def count(texts):
        out = []
        for x in texts:
            try:
                out.append(len(fast.encode(x, allowed_special="all", disallowed_special=())))
            except ValueError:  # its expressions give up on very long runs
                out += slow([x])
        return out

    return count if count(PROBES) == slow(PROBES) else slow


def tokenizer_digest(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs(doc_id, text).

    tokenizer: a file at the same path on every machine. cache: a folder all executors share, made if missing. Null
    text counts as empty and has no tokens. Special strings inside texts are handled as the library does by default.
    Copies of a text are encoded once. Repeated rows and empty tables pass through; other columns are ignored.
    """
    common.arrow(spark := docs.sparkSession)
    version = tokenizer_digest(tokenizer)
    docs = common.id_text(docs).withColumn("text_digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    known = None
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer_digest") == version)
    # one row of a text leaves each task, as the text is a grouping key and the count a fixed-width buffer
    texts = docs.groupBy("text_digest", "text").agg(F.count(F.lit(1)).alias("copies"))
    misses = texts if known is None else texts.join(known, "text_digest", "left_anti")

    def encode(batches):
        count = counter(tokenizer)
        for b in batches:
            yield pd.DataFrame({"text_digest": b["text_digest"], "tokenizer_digest": version, "n_tokens": count(b["text"].tolist())})

    misses.select("text_digest", "text").mapInPandas(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer_digest") == version).groupBy("text_digest").agg(F.max("n_tokens").alias("n_tokens"))
    known = common.written(known, "counts")  # a table of its own, so that the join can split a frequent text's rows
    rows = docs.select("doc_id", "text_digest", F.octet_length("text").cast("long").alias("n_bytes"))
    out = rows.join(known, "text_digest")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
