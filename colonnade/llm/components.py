"""Connected components of a link table: union-find inside each partition, star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_job, join_hot, stored

LINKS = "a bigint, b bigint"


def union_find(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """The smallest member of each node's set."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in list(parent)}


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star for each set within a batch of links."""
    for batch in batches:
        found = union_find(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)))
        nodes = np.array([x for x, top in found.items() if x != top], np.int64)
        tops = np.array([top for x, top in found.items() if x != top], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(tops)], names=["a", "b"])


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of the links ``a``, ``b``.

    Each round puts a star in place of what a partition's links connect, then hangs larger neighbours on the
    smallest (large star) and smaller ones likewise (small star). Minima are partial aggregates, hot nodes are
    joined in several groups that can be split further (``join_hot``), each round is written. Ends when a round changes nothing,
    after a number of rounds of the order of the logarithm of the longest path. Nulls and self-links don't link.
    """
    now = links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b")
    now, before = stored(spark, arrow_job(now, _local, LINKS).distinct(), "links"), None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = join_hot(both, least, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_hot(large, down, "a", "b").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(spark, small.union(down.select("a", F.col("m").alias("b"))).distinct(), "links")
        mark = now.agg(F.count(F.lit(1)), F.sum("a"), F.sum("b"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
