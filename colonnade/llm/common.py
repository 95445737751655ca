"""Small helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.session import scratch_dir

#: White space of the operators: blank and the controls 9 to 13, nothing else.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it.

    Without it a lambda that names an expression from outside works it out again for every element.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """The words of a text: runs without white space. Null and empty texts have none."""
    stripped = strip(F.coalesce(text, F.lit("")))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, SPACE_RUN))


def lines(text: Column) -> Column:
    """The text split at line feeds; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, other letters as they are."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    only_ascii = F.length(text) == F.octet_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, upper, lower))


def stored(spark: SparkSession, frame: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """The frame written to the shared folder and read back: work done once, kept when executors are lost."""
    path = scratch_dir(spark, label)
    frame.write.option("compression", "zstd").options(**(options or {})).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def chosen(rows: DataFrame, most: int, seed: int, key: str = "doc_id") -> tuple[DataFrame, float]:
    """The distinct keys among some ``most`` rows, decided by a hash of the key, and the share of rows they stand for.

    The expected number is bounded by ``most`` whatever the table's size, so the keys may be broadcast.
    """
    known = rows.filter(F.col(key).isNotNull())
    rate = min(1.0, most / max(known.count(), 1))
    place = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)) / float(1 << 40)
    return known.filter(place < rate).select(key).distinct(), rate


#: Shuffle groups per key of ``join_hot``.
PARTS = 4


def join_hot(rows: DataFrame, per_key: DataFrame, key: str, spread: str) -> DataFrame:
    """Inner join of one line per ``key`` to many rows of it, also when one key holds a large share of all.

    Rows go to several shuffle groups by the column ``spread``, a key's line to each of them. That cuts a hot key, and
    gives both sides a shuffle of their own, without which adaptive execution cannot split what is still too large: a
    side that was just aggregated by the key would be joined in place.
    """
    part = F.pmod(F.xxhash64(spread), F.lit(PARTS)).cast("int")
    copies = per_key.withColumn("_part", F.explode(F.array(*[F.lit(i) for i in range(PARTS)])))
    return rows.withColumn("_part", part).join(copies, [key, "_part"]).drop("_part")


def task_count(spark: SparkSession) -> int:
    """How many partitions the session shuffles to; it is sized with the data by whoever runs the job."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_environment(spark: SparkSession) -> None:
    """Workers that were not given this package by the cluster look for it where the driver has it."""
    environment = spark.sparkContext.environment
    folder, paths = str(Path(__file__).parents[2]), environment.get("PYTHONPATH", "")
    if folder not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, folder]))


def arrow_job(
    frame: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    arrow_environment(frame.sparkSession)
    return frame.mapInArrow(task, schema)
