"""A sink that knows what it has written, whatever becomes of the checkpoint.

``<path>/data/batch=<id>`` holds what one micro-batch wrote, ``<path>/ledger`` one line for each (stream, batch, part of
the source) with the highest position written of that part. A batch is there once its lines are, and those appear
together in one file; folders that no line names are the remains of failed attempts, and nobody reads them. A new
checkpoint, or a stream moved to another cluster, so neither repeats what is there nor needs a new folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from colonnade.model import LOG_SCHEMA
from colonnade.streaming.sinks import _start

LEDGER_SCHEMA = "stream string, batch string, part string, position bigint"


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The lines written so far; none where the folder does not exist yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ledger")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/ledger")


def written_positions(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``part, position``: how far each part of the source of stream ``name`` is written."""
    lines = _ledger(spark, path).filter(F.col("stream") == name)
    return lines.groupBy("part").agg(F.max("position").alias("position"))


def append_once(batch: DataFrame, path: str, name: str, schema: T.StructType = LOG_SCHEMA) -> str | None:
    """Append the records of ``batch`` that the ledger does not have yet; the new batch's id, or None without any.

    ``batch`` has the columns of ``schema`` and ``part`` (string) and ``position`` (bigint), the place of the record in
    its source. Positions of a part never go back from one batch to the next: a topic's partition and offset, or a
    file's name and 0 where files are read whole. A record without place fails the batch. One job at a time writes
    under a name; different names do not meet.
    """
    spark = batch.sparkSession
    missing = F.raise_error(F.lit("a record must have a part and a position"))
    part, position = F.col("part").cast("string"), F.col("position").cast("bigint")
    checked = F.when(part.isNull() | position.isNull(), missing).otherwise(position)
    placed = batch.withColumns({"part": part, "position": checked})
    done = written_positions(spark, path, name).withColumnRenamed("position", "_written")
    fresh = placed.join(done, "part", "left").filter(F.col("_written").isNull() | (F.col("position") > F.col("_written")))
    number = uuid.uuid4().hex
    folder = f"{path}/data/batch={number}"
    fresh.select(*schema.names, "part", "position").write.parquet(folder)
    # The lines come from the folder, not from the stream: they say what is there.
    stored = spark.read.schema("part string, position bigint").parquet(folder)
    lines = stored.groupBy("part").agg(F.max("position").alias("position"))
    lines = lines.select(F.lit(name).alias("stream"), F.lit(number).alias("batch"), "part", "position")
    if lines.isEmpty():
        return None
    # A line for each part of the source that the batch has records of, in one file, so they appear together.
    lines.coalesce(1).write.mode("append").parquet(f"{path}/ledger")
    return number


def ledger_stream(stream: DataFrame, path: str, checkpoint: str, name: str, interval: str | None = "5 seconds",
                  schema: T.StructType = LOG_SCHEMA) -> StreamingQuery:
    """Append a stream to ``path``, each record once over all checkpoints; columns as in ``append_once``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(batch, path, name, schema)

    return _start(stream, write, checkpoint, interval)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """The records of all batches that the ledger names; batches of one folder are told apart by their partition."""
    named = _ledger(spark, path).select("batch").distinct()
    all_fields = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    if named.isEmpty():
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(all_fields).parquet(f"{path}/data")
    return stored.join(named, "batch", "left_semi").select(*schema.names)
