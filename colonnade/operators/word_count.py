"""Word count from table to table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.functions.text import words
from colonnade.operators.cells import wide_to_cells
from colonnade.operators.scan import scan


def word_count(table: DataFrame, column: str = "content:info") -> DataFrame:
    """``(word, n)`` over one column of a table; counts start inside each task, so a common word is no hot key."""
    return words(scan(table, columns=[column])).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_cells(table: DataFrame, column: str = "content:info", target: str = "content:info") -> DataFrame:
    """The result as cells of a second table: the word is the row key, the count is stored as text."""
    counted = word_count(table, column)
    return wide_to_cells(counted, F.col("word"), {target: F.col("n").cast("string")})
