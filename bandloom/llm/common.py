"""What the text operators share: the shared folder, written tables, Arrow settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; with texts of 100 kB a batch still stays near 100 MB.
ARROW_ROWS = 1000
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one in local mode only."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if there:
        return there.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="bandloom-"))


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/bandloom-{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors, computes once."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Deletes the files of a table made by written() that nothing needs any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/bandloom-" in path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def arrow(spark: SparkSession) -> None:
    """Bounds the Arrow batches that go to Python."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and text only, null text as the empty one; other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    """batch with null texts as empty ones."""
    i = batch.schema.get_field_index("text")
    return batch.set_column(i, "text", pc.fill_null(batch.column(i).cast(pa.string()), ""))


def filtered(docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list[bool]]]) -> DataFrame:
    """The rows of docs, all columns as they are, that a function of the batch keeps; make builds it once a task.

    Rows are decided where they are read: no shuffle, whatever their ids.
    """
    arrow(docs.sparkSession)

    def run(batches):
        keep = make()
        for b in batches:
            yield b.filter(pa.array(keep(with_text(b)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keep_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose doc_id is in ids(doc_id)."""
    return docs.join(ids.select(F.col("doc_id").alias("_keep")).distinct(), F.expr("doc_id <=> _keep"), "left_semi").select(docs.columns)
