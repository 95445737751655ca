"""Operator 8: benchmark decontamination by spaced seeds.

A window of 13 tokens matches if at most two differ. Three masks share the 13 places out between them (every third
place each), so two substitutions leave one mask untouched: every matching window has a seed in common with its
benchmark item, and comparing the windows around common seeds finds all matches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.arrays import lists, mix, owners, seeded
from colonnade.llm.common import arrow_job, documents, stored

SPAN = 13
SUBSTITUTIONS = 2
MASKS = tuple(tuple(range(first, SPAN, SUBSTITUTIONS + 1)) for first in range(SUBSTITUTIONS + 1))
MIN_TOKENS = 8  # shorter items say too little to be searched; from here to 12 tokens they must occur unchanged
BLOCK_TOKENS = 2_000_000  # of benchmark tokens sent to the executors at once; a larger benchmark takes more passes
FILTER_BITS = 22
FOUND = "doc_id bigint, item_id bigint, start int, end int, n_windows int, n_equal int"


def token_hashes(text: Column) -> Column:
    """Hashes of the tokens: runs of letters and digits in lower case."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(found, lambda token: token != ""), lambda token: F.xxhash64(token))


def seed_hashes(values: np.ndarray, mask: tuple[int, ...], span: int) -> np.ndarray:
    """For each place a hash of the tokens the mask shows in the window that starts there; rows are not told apart."""
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, seeded(1 + mask[0] + 64 * len(mask) + 4096 * span))
    for place in mask:
        total += values[place : place + n] * (seeded(2 * place + 3) | np.uint64(1))
    return mix(total)


def masks_of(length: int) -> list[tuple[tuple[int, ...], int]]:
    """The masks for items of this length, with their span: short items are compared whole."""
    if length >= SPAN:
        return [(mask, SPAN) for mask in MASKS]
    return [(tuple(range(length)), length)] if length >= MIN_TOKENS else []


class Seeds:
    """One block of benchmark items with an index of their seeds."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.item_ids = [item_id for item_id, _ in items]
        self.lengths = np.array([len(tokens) for _, tokens in items], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.tokens = np.concatenate([*(tokens for _, tokens in items), np.zeros(0, np.uint64)])
        # By mask and span: sorted seeds with the item and place of each, and which leading bits occur.
        self.index: dict[tuple[tuple[int, ...], int], tuple[np.ndarray, ...]] = {}
        by_mask: dict[tuple[tuple[int, ...], int], list[tuple[int, np.ndarray]]] = {}
        for number, (_, tokens) in enumerate(items):
            for mask, span in masks_of(len(tokens)):
                by_mask.setdefault((mask, span), []).append((number, seed_hashes(tokens, mask, span)))
        for key, found in by_mask.items():
            hashes = np.concatenate([h for _, h in found])
            item = np.concatenate([np.full(len(h), number) for number, h in found])
            place = np.concatenate([np.arange(len(h)) for _, h in found])
            order = np.argsort(hashes, kind="stable")
            present = np.zeros(1 << FILTER_BITS, bool)
            present[hashes >> np.uint64(64 - FILTER_BITS)] = True
            self.index[key] = (hashes[order], item[order], place[order], present)

    def matches(self, values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, place in the row, item, place in the item, width and equal tokens of every matching window."""
        ends = np.repeat(offsets[1:], np.diff(offsets))
        found: list[tuple[np.ndarray, ...]] = []
        for (mask, span), (seeds, item, place, present) in self.index.items():
            hashes = seed_hashes(values, mask, span)
            at = np.flatnonzero(present[hashes >> np.uint64(64 - FILTER_BITS)])
            at = at[at + span <= ends[at]]
            low, high = (np.searchsorted(seeds, hashes[at], side) for side in ("left", "right"))
            # Hits of frequent seeds are looked at in pieces of bounded size.
            counts = high - low
            at, low, counts = at[counts > 0], low[counts > 0], counts[counts > 0]
            begin, total = 0, np.cumsum(counts)
            while begin < len(at):
                done = total[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(total, done + 500_000, "right")))
                some = counts[begin:end]
                hit = np.repeat(at[begin:end], some)
                first = np.cumsum(some) - some
                entry = np.repeat(low[begin:end] - first, some) + np.arange(int(some.sum()))
                own = self.begins[item[entry]] + place[entry]
                equal = np.zeros(len(hit), np.int64)
                for k in range(span):
                    equal += values[hit + k] == self.tokens[own + k]
                good = equal >= (span - SUBSTITUTIONS if span == SPAN else span)
                found.append((hit[good], item[entry[good]], place[entry[good]], equal[good], np.full(good.sum(), span)))
                begin = end
        hit, item, place, equal, span = (
            (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
        )
        row = owners(offsets)[hit]
        return row, hit - offsets[row], item, place, span, equal


def searcher(seeds) -> Callable:
    """The Arrow task: a row for each document and item of which a window matches."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Seeds = seeds.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                row, at, item, _, span, equal = index.matches(*lists(part.column(1)))
                order = np.lexsort((at, item, row))
                row, at, item, span, equal = (x[order] for x in (row, at, item, span, equal))
                firsts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
                if not len(firsts):
                    continue
                windows = [
                    len(np.unique(at[b:e])) for b, e in zip(firsts, [*firsts[1:], len(row)], strict=True)
                ]
                arrays = [
                    part.column(0).take(pa.array(row[firsts])),
                    pa.array([index.item_ids[i] for i in item[firsts]], pa.int64()),
                    pa.array(at[firsts], pa.int32()),
                    pa.array(np.maximum.reduceat(at + span, firsts), pa.int32()),
                    pa.array(windows, pa.int32()),
                    pa.array(np.maximum.reduceat(equal, firsts), pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in FOUND.split(", ")])

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row for each document of ``docs`` (``doc_id``, ``text``) and item of ``benchmark`` (``item_id``, ``text``)
    that share a window: the tokens it begins and ends at in the document (first to last), how many windows match,
    and the most equal tokens of one window.

    Items are sent out in blocks of bounded size, each compared with all documents. Null and empty texts match
    nothing; rows without an id are compared like others; repeated rows give repeated results, repeated items one
    result each block at most; items of fewer than 8 tokens are not searched. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = stored(spark, benchmark.select("item_id", token_hashes(F.col("text")).alias("hashes")), "items")
    total = items.agg(F.sum(F.size("hashes"))).first()[0] or 0
    blocks = max(1, -(-total // block_tokens))
    hashed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), token_hashes(F.col("text")).alias("hashes"))
    found = []
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "hashes"), F.lit(blocks)) == block)
        rows = mine.orderBy("item_id", F.size("hashes")).collect()
        seeds = Seeds([(r.item_id, np.array(r.hashes, np.int64).view(np.uint64)) for r in rows])
        found.append(arrow_job(hashed, searcher(spark.sparkContext.broadcast(seeds)), FOUND))
    return reduce(DataFrame.unionByName, found)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _windows(tokens: str) -> str:
    """SQL for all windows of ``SPAN`` tokens of a table of token lists, and the tokens each mask shows of them."""
    shown = ", ".join(
        f"'{number}:' || " + " || ' ' || ".join(f"t[{place + 1}]" for place in mask) for number, mask in enumerate(MASKS)
    )
    return f"""SELECT r, i, t, unnest([{shown}]) AS seed FROM (
      SELECT r, i, ts[i : i + {SPAN - 1}] AS t
      FROM (SELECT r, ts, unnest(range(1, len(ts) - {SPAN - 2})) AS i FROM {tokens}))"""


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS ts
  FROM documents
), q AS (
  SELECT row_number() OVER () AS r, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS ts
  FROM benchmark
), dw AS ({_windows("d")}), qw AS ({_windows("q")}),
met AS (
  SELECT DISTINCT dw.r AS r, qw.r AS item, dw.i AS i, {SPAN} AS span,
         len(list_filter(range(1, {SPAN + 1}), lambda k: dw.t[k] = qw.t[k])) AS n
  FROM dw JOIN qw USING (seed)
), whole AS (
  SELECT r, item, i, n AS span, n FROM (
    SELECT d.r AS r, q.r AS item, len(q.ts) AS n, q.ts AS item_ts, d.ts AS ts,
           unnest(range(1, len(d.ts) - len(q.ts) + 2)) AS i
    FROM d JOIN q ON len(q.ts) BETWEEN {MIN_TOKENS} AND {SPAN - 1} AND list_has_all(d.ts, q.ts))
  WHERE ts[i : i + n - 1] = item_ts
), found AS (
  SELECT * FROM met WHERE n >= {SPAN - SUBSTITUTIONS} UNION ALL SELECT * FROM whole
)
SELECT doc_id, item_id, min(i) - 1 AS start, max(i + span) - 1 AS "end", count(DISTINCT i) AS n_windows, max(n) AS n_equal
FROM found JOIN d USING (r) JOIN q ON q.r = item GROUP BY found.r, item, doc_id, item_id
"""
