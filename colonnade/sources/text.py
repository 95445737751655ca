"""Delimited text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions.keys import copy_blocks, numbered_copies, random_key, with_content_key
from colonnade.functions.text import parsed_lines
from colonnade.operators.cells import wide_to_cells

LOG_FIELDS = ["time", "userId", "keyWord", "ranking", "url"]


def read_delimited(spark: SparkSession, path: str, fields: list[str], separator: str = ",",
                   strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good records (the named fields, all text) and rejected lines (``line, reject``) of a file without header."""
    parsed = parsed_lines(spark.read.text(path), fields, separator, strict)
    good = parsed.filter(F.col("reject").isNull()).select("record.*")
    bad = parsed.filter(F.col("reject").isNotNull()).select("line", "reject")
    return good, bad


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Tab-separated search log: time, userId, keyWord, ranking, url."""
    return read_delimited(spark, path, LOG_FIELDS, "\t")


def keyed_log(records: DataFrame, random: bool = False) -> DataFrame:
    """Log lines with a row key made from the line's content, or a random UUID if asked for."""
    return records.withColumn("row_key", random_key()) if random else with_content_key(records, LOG_FIELDS)


def log_columns(family: str = "cf1") -> dict[str, Column]:
    return {f"{family}:{name}": F.col(name) for name in LOG_FIELDS}


def log_cells(records: DataFrame, family: str = "cf1", random: bool = False) -> DataFrame:
    """Five cells per log line."""
    return wide_to_cells(keyed_log(records, random), F.col("row_key"), log_columns(family))


def bulk_load_log(records: DataFrame, path: str, family: str = "cf1") -> None:
    """Sorted load of log lines under content keys.

    Distinct lines are shuffled once, by key; copies and cells are written out afterwards, where they belong.
    """
    blocks = copy_blocks(records, LOG_FIELDS)
    ranged = blocks.repartitionByRange("digest", "first").sortWithinPartitions("digest", "first")
    keyed = numbered_copies(ranged, LOG_FIELDS)
    wide_to_cells(keyed, F.col("row_key"), log_columns(family)).write.mode("overwrite").parquet(path)
