"""Incremental ingest with a status table and bounded retries.

Status rows are (key, attempts, ok, file). Each batch tries keys never seen and keys that failed fewer than MAX_ATTEMPTS
times, adds an attempt, and writes catalog rows for successes only. A batch has named outputs (catalog rows, file names,
statistics), each a table of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MAX_ATTEMPTS = 4
RESCAN = "24 hours"
STATUS = "key string, attempts int, ok boolean, file string"


def pending(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidate keys without a status row."""
    return candidates.select("key").distinct().join(known.select("key"), "key", "left_anti")


def retries(status: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    return status.filter((F.col("attempts") < limit) & ~F.col("ok"))


def advance(status: DataFrame, candidates: DataFrame, convert: Callable[[DataFrame], DataFrame], limit: int = MAX_ATTEMPTS) -> DataFrame:
    """The status table after one scan; convert takes rows(key) and returns rows(key, ok, file)."""
    todo = retries(status, limit).select("key").unionByName(pending(candidates, status))
    tried = convert(todo).select("key", F.col("ok").alias("new_ok"), F.col("file").alias("new_file"))
    old = status.join(todo, "key", "left_anti")
    new = tried.join(status, "key", "left").select("key", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempts"), F.col("new_ok").alias("ok"), F.coalesce("new_file", F.lit("")).alias("file"))
    return old.unionByName(new)


def latest(spark: SparkSession, path: str, but: tuple[str, int] | None = None) -> DataFrame:
    """The newest status of each key in a folder with a part for each batch of each stream, leaving out a stream's
    batches from a number on; none when the folder is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], STATUS)
    t = spark.read.schema(STATUS + ", stream string, batch long").parquet(path)
    if but is not None:
        t = t.filter((F.col("stream") != but[0]) | (F.col("batch") < but[1]))
    return t.groupBy("key").agg(F.max_by(F.struct("attempts", "ok", "file"), "attempts").alias("s")).select("key", "s.*")


def write_batch(df: DataFrame, path: str, stream: str, batch: int) -> None:
    """df as the part of one batch of a stream; a replay replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch}")


def checked(rows: DataFrame, column: str = "value") -> DataFrame:
    """The rows, but for one whose column is no JSON, which raises."""
    bad = F.col(column).isNotNull() & F.try_parse_json(column).isNull()
    return rows.withColumn(column, F.when(bad, F.raise_error(F.lit("not JSON"))).otherwise(F.col(column)))


def ingest(files: DataFrame, status_path: str, convert: Callable[[DataFrame], DataFrame], checkpoint: str, sink: Callable[[DataFrame], None] | None = None, outputs: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]] | None = None, tasks: int | None = None, once: bool = True) -> StreamingQuery:
    """Runs a stream of files(key) through convert, which takes rows(key) and returns rows(key, ok, file, ...).

    outputs: by name, a folder and what to write to it from the rows that converted. All outputs of a batch are written
    before its status, each as a part of its own that a replay replaces, and attempts are counted from the batches
    before; so a batch that is replayed after a crash leaves the same as one that ran once. sink takes the rows that
    converted, before the status is written, and has to bear replays itself. tasks: how many share the conversion of a
    batch. The checkpoint names the stream; several may share one status table.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        status = latest(spark, status_path, (stream, number))
        todo = retries(status).select("key").unionByName(pending(df, status))
        done = convert(todo.repartition(tasks) if tasks else todo).persist()
        for path, select in (outputs or {}).values():
            write_batch(select(done.filter("ok")), path, stream, number)
        if sink:
            sink(done.filter("ok"))
        counted = done.select("key", F.col("ok").alias("new_ok"), F.col("file").alias("new_file")).join(status, "key", "left")
        write_batch(counted.select("key", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempts"), F.col("new_ok").alias("ok"), F.coalesce("new_file", F.lit("")).alias("file")), status_path, stream, number)
        done.unpersist()

    w = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=RESCAN)).start()
