"""The registered queries of the text operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, decontamination, exact_dedup, langid, licenses, mixing, secrets, simhash, substring_dedup, tokens, url_filter

#: Dated entries of the URL list: key, category, day, listed (or delisted).
URL_LIST = (
    ("casino-win.example.com", "gambling", "2024-01-01", True),
    ("free-bets.example.com", "gambling", "2024-01-01", True),
    ("free-bets.example.com", "gambling", "2024-09-01", False),
    ("free-bets.example.com", "gambling", "2025-02-01", True),
    ("cheap-pills.example.com", "pharmacy", "2024-06-01", True),
    ("example.net/de", "review", "2024-03-01", True),
    ("example.net/de", "review", "2024-12-01", False),
    ("m.example.org", "mirror", "2024-05-01", True),
)
URL_DAYS = 730


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = secrets.secrets(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    strongest = F.coalesce(F.array_max(F.transform("spans", lambda s: s["log_guesses"])), F.lit(0.0))
    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "guess")), 256).alias("base_sha256"), joined("spans").alias("spans"), count("guess"), strongest.alias("max_log_guesses"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(common.documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(common.documents(spark, sf_dir))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(common.documents(spark, sf_dir))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    # the table has no fetch time: pages stand as fetched on consecutive days, in turn over two years
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id"), F.lit(URL_DAYS)).cast("int")).alias("fetched_on"))
    entries = spark.createDataFrame(list(URL_LIST), "list_key string, category string, day string, listed boolean")
    found = url_filter.url_filter(captures, entries)
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "valid_from")})


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # a cache of its own for each run, so that every run encodes all different texts
    return tokens.token_counts(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), common.new_path(spark, "token-cache"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(common.documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_language_id, op2_secret_scan, op3_simhash_near_dedup, op4_exact_dedup, op5_source_mixing, op6_license_scan, op7_url_filter, op8_token_counts, op9_substring_dedup, op10_decontamination)}
