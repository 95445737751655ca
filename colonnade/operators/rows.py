"""Grouping by row or cell, and joining facts about rows back to their cells, also when one row is huge."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from colonnade.model import COORDINATES

# Shuffle groups per row key. Copying the one line per row this often is cheap next to its cells.
PARTS = 4


def group_by_key(frame: DataFrame, *keys: str) -> GroupedData:
    """Group by string keys, led by their hash.

    Aggregates that keep strings are computed by sorting. The hash changes no group, but lets that sort tell
    rows apart by eight bytes instead of by strings that often share long prefixes.
    """
    return frame.withColumn("key_hash", F.xxhash64(*keys)).groupBy("key_hash", *keys)


def deal_versions(log: DataFrame) -> DataFrame:
    """The same cells or entries, dealt over the shuffle partitions by cell and version.

    Spark sorts before it aggregates strings, in the tasks that read: one file that one task reads, cut into cells
    there, is then one sort. The versions of a hot cell part too, and a partition that is still large can be split.
    """
    return log.hint("rebalance", *COORDINATES, "ts", "seq")


def join_rows(cells: DataFrame, per_row: DataFrame, how: str, parts: int = PARTS) -> DataFrame:
    """Join ``per_row`` (at most one line per ``row_key``) to the cells of its row.

    The cells of a row go to several shuffle groups by column, and its line to each of them. Besides cutting
    a huge row at once, this gives both join sides a shuffle of their own, which is what the skew handling of
    adaptive execution needs to cut the groups further by measured size; a side that was just aggregated by
    the bare row key would be joined in place and never be split.
    """
    part = F.pmod(F.xxhash64("family", "qualifier"), F.lit(parts)).cast("int")
    every_part = F.explode(F.array(*[F.lit(i) for i in range(parts)]))
    copies = per_row.withColumn("part", every_part)
    return cells.withColumn("part", part).join(copies, ["row_key", "part"], how).drop("part")
