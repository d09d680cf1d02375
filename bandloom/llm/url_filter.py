"""URL filters by a temporal list join, in DataFrame functions only.

Dated list entries (a key is listed or delisted on a day) become validity intervals. Keys are domains, which hold for
their subdomains too, or a domain with the first path segment. An as-of join finds for each capture the entries that
were active when it was fetched: list entries meet the different keys of the captures (each once, whatever the number
of captures), each page key carries its intervals, and captures pick theirs by fetch time, one row per capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)"


def intervals(entries: DataFrame) -> DataFrame:
    """list_key, category, valid_from, valid_to (null: open; exclusive) of entries(list_key, category, day, listed).

    Of entries of one key and category on one day, listed wins. Entries without key or day are void; a delisting of
    what is not listed has no effect.
    """
    e = entries.filter("list_key is not null and day is not null").groupBy(F.lower("list_key").alias("list_key"), F.coalesce("category", F.lit("")).alias("category"), F.col("day").cast("date").alias("day")).agg(F.max(F.coalesce("listed", F.lit(True))).alias("listed"))
    at = Window.partitionBy("list_key", "category").orderBy("day")
    return e.withColumn("valid_to", F.lead("day").over(at)).filter("listed").select("list_key", "category", F.col("day").alias("valid_from"), "valid_to")


def host(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, host, fetched_on, blocked, list_key, category, valid_from of captures(page_id, url, fetched_on).

    Of several active entries the longest key decides, then the latest valid_from, then the smallest category. A null
    or unparsable url has host '' and is not blocked, nor is a capture without a day. Repeated rows get equal results;
    empty tables give an empty result, an empty list blocks nothing. Other columns are ignored.
    """
    c = captures.select("page_id", "url", host(F.col("url")).alias("host"), F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), SEGMENT, 1)).alias("segment"), F.col("fetched_on").cast("date").alias("fetched_on"))
    pages = c.filter("host <> ''").groupBy("host", "segment").agg(F.count(F.lit(1)).alias("n")).select("host", "segment")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = pages.withColumn("suffix", F.explode(suffixes)).withColumn("list_key", F.explode(F.array_distinct(F.array(F.col("suffix"), F.concat("suffix", "segment")))))
    # entries of a page key: as many as its list keys have changes
    found = keys.join(intervals(entries), "list_key").groupBy("host", "segment").agg(F.collect_list(F.struct(F.length("list_key").alias("len"), F.col("valid_from"), F.col("category"), F.col("list_key"), F.col("valid_to"))).alias("found"))
    found = common.written(found, "found")  # a table of its own, so that the join can split a frequent host's captures
    active = F.filter("found", lambda x: (x["valid_from"] <= F.col("fetched_on")) & (x["valid_to"].isNull() | (x["valid_to"] > F.col("fetched_on"))))
    better = lambda a, b: F.when(a["len"] != b["len"], b["len"] - a["len"]).when(a["valid_from"] != b["valid_from"], F.datediff(b["valid_from"], a["valid_from"])).when(a["category"] < b["category"], -1).when(a["category"] > b["category"], 1).otherwise(0)
    out = c.join(found, ["host", "segment"], "left").withColumn("best", F.try_element_at(F.array_sort(active, better), F.lit(1)))
    return out.select("page_id", "url", "host", "fetched_on", F.col("best").isNotNull().alias("blocked"), F.col("best.list_key").alias("list_key"), F.col("best.category").alias("category"), F.col("best.valid_from").alias("valid_from"))
