"""Streams into and out of cell tables.

Every sink writes micro-batch N to ``<path>/batch_id=N`` in overwrite mode. A batch that is replayed after a
failure replaces its own folder, so with a checkpoint each record lands exactly once. Batch ids restart with
a new checkpoint; use a new path with it. With a named table the folder also becomes a batch of that table, which
batch jobs append to as well; read through the catalog, nobody lists the folders, and compaction puts one in their
place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from colonnade.functions.keys import time_key_text
from colonnade.functions.text import parse_lines
from colonnade.model import DELETE_NEWEST, LOG_COLUMNS, LOG_SCHEMA, PUT, split_column
from colonnade.operators.cells import join_values, wide_to_cells
from colonnade.operators.filters import KeyPrefix
from colonnade.operators.mutations import put
from colonnade.operators.scan import entries_for, scan
from colonnade.sources.tables import create_table, publish_batch

UPSERT_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("reject", T.StringType())])
JOINED_SCHEMA = T.StructType([T.StructField("row_key", T.StringType()), T.StructField("value", T.StringType())])


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A message topic as ``value STRING, ts, seq, millis, partition, offset``, as both sinks below take it.

    Needs Spark's Kafka connector on the class path. Messages of one key share a topic partition, so its offset
    orders them; over partitions only both numbers together tell records apart. ``maxOffsetsPerTrigger`` sets the
    batch size.
    """
    source = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    )
    return topic_records(source.load())


def topic_records(messages: DataFrame) -> DataFrame:
    """``value, timestamp, partition, offset`` as the columns of ``topic_stream``."""
    return messages.select(
        F.col("value").cast("string").alias("value"),
        F.unix_micros("timestamp").alias("ts"),
        F.col("offset").cast("bigint").alias("seq"),
        F.unix_millis("timestamp").alias("millis"),
        F.col("partition").cast("bigint").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
    )


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
           interval: str | None, output_mode: str = "append") -> StreamingQuery:
    """Run every ``interval``, or through everything now available and stop when it is None."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


def _write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _cell(family: str | None, qualifier: str | None, value: Column) -> Column:
    names = [F.lit(part).cast("string").alias(name) for part, name in ((family, "family"), (qualifier, "qualifier"))]
    return F.struct(*names, value.alias("value"))


def _publish(spark: SparkSession, table: str, path: str, batch_id: int, folder: str) -> None:
    """The folder as a batch of the table, named after the stream's path; a folder that was not written is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        stream = hashlib.md5(path.encode()).hexdigest()
        publish_batch(spark, table, f"stream-{stream}-{batch_id}", folder)


def upsert_stream(stream: DataFrame, columns: list[str], path: str, checkpoint: str, separator: str = ",",
                  interval: str | None = "5 seconds", table: str | None = None) -> StreamingQuery:
    """Delimited records (``value, ts, seq``): the first field is the row key, the others the columns.

    Puts and rejected lines are written side by side in one pass over the batch. Read them with
    ``read_upserts``, through ``resolve_latest``, and ``read_rejects``: the newest version wins however late
    a record arrives, and no state is kept. With ``table`` the puts also appear in that named table, which is
    created if it is missing; rejected lines stay in the folder.
    """
    if table:
        families = sorted({split_column(name)[0] for name in columns})
        create_table(stream.sparkSession, table, families)
    parsed = parse_lines(stream, ["row_key", *columns], separator)
    good = F.col("reject").isNull()
    puts = F.array(*[_cell(*split_column(name), F.col(f"`{name}`")) for name in columns])
    # A rejected line becomes one entry without coordinates that holds the line itself.
    refused = F.array(_cell(None, None, F.col("value")))
    log = parsed.select(
        F.when(good, F.col("row_key")).alias("row_key"), "ts", "seq", "reject", (~good).alias("rejected"),
        F.explode(F.when(good, puts).otherwise(refused)).alias("cell"),
    ).select("row_key", "cell.*", "ts", "seq", F.lit(PUT).alias("op"), "reject", "rejected")

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        batch.write.partitionBy("rejected").mode("overwrite").parquet(folder)
        if table:
            _publish(batch.sparkSession, table, path, batch_id, f"{folder}/rejected=false")

    return _start(log, write, checkpoint, interval)


def _read_upserts(spark: SparkSession, path: str, rejected: bool) -> DataFrame:
    return spark.read.schema(UPSERT_SCHEMA).parquet(path).filter(F.col("rejected") == rejected)


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    return _read_upserts(spark, path, False).select(*LOG_COLUMNS)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _read_upserts(spark, path, True).select(F.col("value").alias("line"), "reject", "ts", "seq")


def raw_append_stream(stream: DataFrame, path: str, checkpoint: str, column: str = "cf1:name",
                      rebalance: bool = False, interval: str | None = "1 second",
                      table: str | None = None) -> StreamingQuery:
    """Store each record whole, in one column, under an event-time key.

    Records are ``value, millis`` and what tells those of one millisecond apart: ``partition, offset`` of a topic,
    or one number ``tiebreak``. ``rebalance`` evens out the write tasks of a lopsided source at the price of a
    shuffle. With ``table`` the batches also appear in that named table, which is created if it is missing.
    """
    if table:
        create_table(stream.sparkSession, table, [split_column(column)[0]])
    ties = ["partition", "offset"] if {"partition", "offset"} <= set(stream.columns) else ["tiebreak"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spread = batch.hint("rebalance") if rebalance else batch
        key = time_key_text(F.col("millis"), *[F.col(name) for name in ties])
        cells = wide_to_cells(spread, key, {column: F.col("value")}, F.col("millis"), F.col(ties[-1]))
        _write_batch(put(cells), path, batch_id)
        if table:
            _publish(batch.sparkSession, table, path, batch_id, f"{path}/batch_id={batch_id}")

    return _start(stream, write, checkpoint, interval)


def latest_stream(log: DataFrame, path: str, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """Running newest entry per cell, and per row and family for their delete markers: each batch emits the changes.

    Takes a log, or cells, which count as puts. Late entries with an older version change nothing. Read the output
    through ``resolve_latest``; a ``delete_newest`` entry fails the stream, for it needs older versions. State is one row per cell and marker ever seen, which is the table itself: for a
    table without bound, append the stream to it (``raw_append_stream``, ``upsert_stream``) and resolve when
    reading, which keeps no state.
    """
    entries = log if "op" in log.columns else log.withColumn("op", F.lit(PUT))
    refused = F.raise_error(F.lit("delete_newest entries need all versions: append the stream"))
    entries = entries.withColumn("op", F.when(F.col("op") == DELETE_NEWEST, refused).otherwise(F.col("op")))
    newest = F.max(F.struct("ts", "seq", "op", "value")).alias("newest")
    # A marker of a family or row is kept beside the cells and newer puts beside the markers.
    running = entries.groupBy("row_key", "family", "qualifier").agg(newest)
    cells = running.select("row_key", "family", "qualifier", "newest.ts", "newest.seq", "newest.value", "newest.op")

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch.select(*LOG_COLUMNS), path, batch_id)

    return _start(cells, write, checkpoint, interval, output_mode="update")


def scan_stream(spark: SparkSession, table_path: str, schema: T.StructType, path: str, checkpoint: str,
                separator: str = ",", start: str = "", stop: str = "", columns: list[str] | None = None,
                prefix: str = "") -> StreamingQuery:
    """Emit a bounded range of a stored table as ``(row_key, joined values)`` and stop.

    The key bounds, the key prefix and the column selection (with the markers it needs) are predicates of the
    stream, so they reach the file scan. All files form one micro-batch, so no row is cut in two; the batch is
    held while its deletes are resolved, and read once.
    """
    where = KeyPrefix(prefix) if prefix else None
    table = spark.readStream.schema(schema).parquet(table_path)
    wanted = [c for c in LOG_COLUMNS if c in schema.names]
    near = entries_for(table, start, stop, columns, where).select(*wanted)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            joined = join_values(scan(held, start, stop, columns, where), separator)
            _write_batch(joined, path, batch_id)
        finally:
            held.unpersist()

    return _start(near, write, checkpoint, interval=None)
