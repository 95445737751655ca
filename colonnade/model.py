"""The two table shapes every operator reads and returns.

Cell form has one row per stored value; a mutation log is cell form plus the operation that wrote it.
``(ts, seq)`` is the version: callers supply both, because Spark has no arrival order of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUT = "put"
DELETE_ROW = "delete_row"
DELETE_FAMILY = "delete_family"
DELETE_COLUMN = "delete_column"
DELETE_NEWEST = "delete_newest"

COORDINATES = ["row_key", "family", "qualifier"]
CELL_COLUMNS = [*COORDINATES, "ts", "seq", "value"]
LOG_COLUMNS = [*CELL_COLUMNS, "op"]

CELL_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
LOG_SCHEMA = T.StructType([*CELL_SCHEMA.fields, T.StructField("op", T.StringType())])


def split_column(name: str) -> tuple[str, str | None]:
    """``'info:name'`` -> ``('info', 'name')``; ``'info'`` -> ``('info', None)``, the whole family."""
    family, found, qualifier = name.partition(":")
    if not family:
        raise ValueError(f"column {name!r} names no family")
    return family, qualifier if found else None


def is_column(name: str) -> Column:
    """Predicate: the cell belongs to this family, or to this one ``family:qualifier``."""
    family, qualifier = split_column(name)
    matches = F.col("family") == family
    return matches if qualifier is None else matches & (F.col("qualifier") == qualifier)


def version() -> Column:
    return F.struct("ts", "seq")
