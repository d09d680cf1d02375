"""A corpus pipeline of five stages, each a text operator: language ID, exact dedup, near dedup, decontamination, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandloom.llm import common, decontamination, exact_dedup, langid, mixing, simhash

#: A document whose language scores less is rejected.
MIN_LANGUAGE_SCORE = 0.35


def odd_ids(docs: DataFrame) -> DataFrame:
    """odd: the doc_ids that more than one row of docs has, and null if a row has it."""
    return common.written(docs.groupBy(F.col("doc_id").alias("odd")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or odd is null").select("odd"), "odd")


def by_row(docs: DataFrame, keep) -> DataFrame:
    """The rows of docs, all columns, that keep(docs) keeps by doc_id, decided for each row.

    Rows whose doc_id is null or not theirs alone take keys under the least doc_id meanwhile.
    """
    ids = odd_ids(docs)
    if ids.isEmpty():
        return keep(docs)
    on = F.expr("doc_id <=> odd")
    least = F.coalesce(F.least(F.min("doc_id"), F.lit(0)), F.lit(0)).cast("long")
    first = docs.agg(least.alias("v")).first()["v"]
    own = docs.join(ids, on, "left_anti").withColumn("_id", F.col("doc_id"))
    others = docs.join(ids, on, "left_semi").withColumn("_id", F.lit(first) - 1 - F.monotonically_increasing_id())
    keyed = common.written(own.unionByName(others), "keyed")
    found = keep(keyed.drop("doc_id").withColumnRenamed("_id", "doc_id")).select(F.col("doc_id").alias("_kept"))
    return keyed.join(found, F.expr("_id = _kept"), "left_semi").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, null or empty, and those whose best language scores under the minimum.

    Rows are decided one by one, so null and repeated doc_ids and repeated rows make no difference, and equal texts
    stay or go together. An empty table stays empty; without labelled text nothing can be told, and all rows go.
    """
    return langid.keep_known(docs, langid.fit(docs.filter(~langid.held_out())), MIN_LANGUAGE_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, of those with the largest doc_id; rows of different texts all do, whatever their ids.

    Null and empty texts are equal. Of repeated rows one stays, of rows without a doc_id with one text one. An empty
    table stays empty.
    """
    found = exact_dedup.exact_dedup(docs).filter("kept")
    ids = odd_ids(docs)
    if ids.isEmpty():
        return common.keep_rows(docs, found)
    on = F.expr("doc_id <=> odd")
    plain = common.keep_rows(docs.join(ids, on, "left_anti"), found)
    texts = found.join(ids, on, "left_semi").select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_sha")).distinct()
    rows = docs.join(ids, on, "left_semi").withColumn("_text", exact_dedup.sha(F.coalesce("text", F.lit(""))))
    rest = rows.join(texts, F.expr("doc_id <=> _keep and _text = _sha"), "left_semi").dropDuplicates(["doc_id", "_text"])
    return plain.unionByName(rest.select(docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays.

    Rows without a doc_id of their own count as smaller than any, in an order that only a rerun on the same files
    repeats. Texts without words are one group, null ones among them; repeated rows are near copies. An empty table
    stays empty.
    """
    return by_row(docs, lambda d: common.keep_rows(d, simhash.similar_groups(d).filter("doc_id <=> component_id")))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item.

    Rows are decided one by one, so null and repeated doc_ids make no difference. Null and empty texts and empty tables
    stay as they are, as does everything if there are no items.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.keep_clean(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document with what the mix takes of it; null texts have size 0, null sources are a source, repeated
    rows count one by one, an empty table gives no rows."""
    return mixing.mix(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean), ("mixing", mix)]
#: The trained, iterative and approximate stages have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
