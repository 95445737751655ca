"""Upserts that rewrite only the files they touch.

``<path>/data/<generation>`` holds files of rows, ``<path>/live/version=<n>`` the list of files that make up version n.
An upsert looks up which live files hold a changed key (the key column alone is read), rewrites these with the changes,
and publishes a list in which the new files stand for them. A list appears as one file; readers take the newest one and
see all of an upsert or nothing. All other files keep their names and are not read. Files of older versions stay until
the caller removes them, so a running reader is not disturbed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.sources.tables import upsert

FILE = "_metadata.file_path"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, version bigint").parquet(f"{path}/live")


def live_files(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The newest version and its files, as many as any scan of the table lists."""
    lists = _versions(spark, path)
    version = lists.agg(F.max("version")).first()[0]
    rows = lists.filter(F.col("version") == version).filter("file <> ''").collect()
    return version, sorted(row["file"] for row in rows)


def _publish(spark: SparkSession, path: str, version: int, files: list[str]) -> None:
    # The empty name keeps the list of a table without files.
    names = spark.createDataFrame([(name,) for name in ["", *files]], "file string")
    names.coalesce(1).write.mode("errorifexists").parquet(f"{path}/live/version={version}")


def _files_in(spark: SparkSession, folder: str, schema: T.StructType) -> list[str]:
    """Files that hold rows; a file without rows is never listed."""
    return [row[0] for row in spark.read.schema(schema).parquet(folder).select(FILE).distinct().collect()]


def _read(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def _write(rows: DataFrame, path: str, key: str, rows_per_file: int | None) -> list[str]:
    spark, folder = rows.sparkSession, f"{path}/data/{uuid.uuid4().hex}"
    writer = rows.repartitionByRange(key).sortWithinPartitions(key).write
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(folder)
    return _files_in(spark, folder, rows.schema)


def create_keyed_table(rows: DataFrame, path: str, key: str, rows_per_file: int | None = None) -> None:
    """Version 0: ``rows``, one for each ``key``, with the version columns ``ts`` and ``seq``, sorted into files by key."""
    _publish(rows.sparkSession, path, 0, _write(rows, path, key, rows_per_file))


def read_keyed_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _read(spark, live_files(spark, path)[1], schema)


def upsert_files(changes: DataFrame, path: str, key: str, schema: T.StructType,
                 rows_per_file: int | None = None) -> tuple[int, int]:
    """Apply ``changes`` as ``tables.upsert`` does (null means "not set"); files rewritten, and files there were.

    ``schema`` is that of the table; ``changes`` has ``key``, ``ts``, ``seq`` and some of the other columns. New keys go
    to new files. Without changes nothing is published. Keys that spread over all files rewrite all of them: keep
    changes that belong together close in the key. One upsert at a time: of two at once the second to publish fails.
    A null key fails the job.
    """
    spark = changes.sparkSession
    missing = F.raise_error(F.lit("a key must not be null"))
    checked = changes.withColumn(key, F.when(F.col(key).isNull(), missing).otherwise(F.col(key)))
    low, high = checked.agg(F.min(key), F.max(key)).first()
    version, files = live_files(spark, path)
    if low is None:
        return 0, len(files)
    # Bounds that reach the files' statistics; then the keys themselves.
    near = _read(spark, files, schema).filter(F.col(key).between(F.lit(low), F.lit(high)))
    keys = checked.select(key).distinct()
    touched = []
    if files:
        held = near.select(key, F.col(FILE).alias("file")).join(keys, key, "left_semi")
        touched = [row["file"] for row in held.select("file").distinct().collect()]
    done = upsert(_read(spark, touched, schema), checked, key, versions=True).select(*schema.names)
    new = _write(done, path, key, rows_per_file)
    _publish(spark, path, version + 1, sorted({*files} - {*touched} | {*new}))
    return len(touched), len(files)
