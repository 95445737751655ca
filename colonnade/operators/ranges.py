"""Key ranges: which parts of a table a scan touches, and how many rows lie in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.operators.scan import scan


def clip_ranges(bounds: list[tuple[str, str]], start: str = "", stop: str = "") -> list[tuple[str, str]]:
    """The overlap of each ``[low, high)`` with ``[start, stop)``, without the empty ones; '' is open.

    ``bounds`` is the table's own list of ranges, sorted and disjoint, as a client sees it.
    """
    clipped = []
    for low, high in bounds:
        first = max(low.encode(), start.encode()).decode()
        last = min((b for b in (high, stop) if b), key=str.encode, default="")
        if not last or first.encode() < last.encode():
            clipped.append((first, last))
    return clipped


def count_not_above(limits: list[str], key: Column) -> Column:
    """How many of the sorted limits are <= key: a binary search, so many ranges cost little per row."""
    table = F.array(*[F.lit(limit) for limit in limits])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(limits).bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(limits)) & (F.get(table, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def key_range_stats(spark: SparkSession, cells: DataFrame, bounds: list[tuple[str, str]], start: str = "",
                    stop: str = "") -> DataFrame:
    """Rows, cells and the longest row of every clipped range, ranges without rows included.

    A log counts by what it shows. Cells are first counted per row key, then each key is placed in its range: no
    range join.
    """
    ranges = clip_ranges(bounds, start, stop)
    listed = spark.createDataFrame(
        [(i, low, high) for i, (low, high) in enumerate(ranges, 1)],
        "range_no int, range_start string, range_stop string",
    )
    if not ranges:
        return listed.selectExpr("range_start", "range_stop", "0L n_rows", "0L n_cells", "0L longest_row")
    key = F.col("row_key")
    place = count_not_above([low for low, _ in ranges], key)
    stops = F.array(*[F.lit(high) for _, high in ranges])
    per_row = scan(cells, start, stop).groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
    placed = per_row.withColumn("range_no", place).withColumn("high", F.get(stops, F.col("range_no") - 1))
    counted = (
        placed.filter((F.col("range_no") > 0) & ((F.col("high") == "") | (key < F.col("high"))))
        .groupBy("range_no")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_cells"), F.max("n").alias("longest_row"))
    )
    zero = F.lit(0).cast("bigint")
    return listed.join(counted, "range_no", "left").select(
        "range_start",
        "range_stop",
        *[F.coalesce(name, zero).alias(name) for name in ("n_rows", "n_cells", "longest_row")],
    )
