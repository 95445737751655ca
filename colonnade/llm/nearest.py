"""Operator 11: nearest neighbours by inner product, with an adaptive scan of dimensions.

Vectors are rotated at random and kept in lists around k-means centers, their dimensions in blocks of columns. Within a
probed list a query meets all rows in the first block of columns; after each block a hypothesis test on the partial inner
product gives up the candidates that can hardly reach the query's threshold, so most never see the last block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_environment, arrow_job, stored

NEAREST = 20
LIST_ROWS = 512  # rows of a list, on average, up to the most lists
MOST_LISTS = 4096
SAMPLE_PER_LIST = 64  # rows the centers are fit on
WIDTH = 16  # dimensions in a block of columns
SHARD_ROWS = 8192  # rows that are scanned together: some lists, or a part of a long one
CHUNK = 16384  # queries that meet a shard at once
FIRST = 6  # times as many rows as neighbours make the lists that are scanned first
Z = 3.0  # standard deviations below what a neighbour's partial sum is expected to be
MISS = 0.02  # of the expected hits, that lists which are not probed may hold
CELLS = 1 << 20  # pairs of queries and rows at once
ROUNDING = 1e-5  # of the norms' product, in which 32-bit sums may be wrong


def usable(vectors: DataFrame, ids: str, column: str) -> DataFrame:
    """``vec_id`` and ``vector`` of the rows that take part."""
    named = vectors.select(F.col(ids).cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The lists as rows of a matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(11).normal(size=(dims, dims)))[0]


@dataclass
class Lists:
    """What the driver knows of the lists, at most ``MOST_LISTS``: center, rows, spread, first shard, shards."""

    centers: np.ndarray
    turn: np.ndarray
    rows: np.ndarray | None = None
    spread: np.ndarray | None = None
    shard: np.ndarray | None = None
    shards: np.ndarray | None = None

    @property
    def dims(self) -> int:
        return self.centers.shape[1]

    def described(self, stats: list) -> Lists:
        count = len(self.centers)
        rows, gap = np.zeros(count, np.int64), np.zeros(count)
        for r in stats:
            rows[r["list"]], gap[r["list"]] = r["n"], r["gap"]
        shards = np.maximum(-(-rows // SHARD_ROWS), 1)
        shard, at, held = np.zeros(count, np.int64), 0, 0
        for one in range(count):
            if held and held + rows[one] > SHARD_ROWS:
                at, held = at + 1, 0
            shard[one] = at
            held += rows[one]
            if shards[one] > 1:
                at, held = at + int(shards[one]), 0
        return Lists(self.centers, self.turn, rows, np.sqrt(gap / self.dims), shard, shards)


def centers(rows: DataFrame, count: int, dims: int) -> np.ndarray:
    """k-means centers of a sample of at most ``SAMPLE_PER_LIST * MOST_LISTS`` rows (expected number)."""
    lists = int(min(MOST_LISTS, max(1, count // LIST_ROWS)))
    if lists == 1:
        return np.zeros((1, dims))
    rate = min(1.0, lists * SAMPLE_PER_LIST / count)
    place = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 40)) / float(1 << 40)
    padded = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vector")))
    sample = stored(rows.sparkSession, rows.filter(place < rate).select(padded.alias("vector")), "vector-sample")
    points = sample.select(array_to_vector("vector").alias("features"))
    if points.isEmpty():
        return np.zeros((1, dims))
    return np.array(KMeans(k=lists, maxIter=10, seed=1).fit(points).clusterCenters())


def indexer(lists: Lists, blocks: int) -> Callable:
    """The Arrow task that puts each row into the list of its closest center and rotates it."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (lists.centers**2).sum(1) / 2
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = matrix(part.column(1), lists.dims)
                close = (x @ lists.centers.T - half).argmax(1)
                gap = ((x - lists.centers[close]) ** 2).sum(1)
                turned = (x @ lists.turn).astype("<f4")
                columns = [np.ascontiguousarray(turned[:, k * WIDTH : (k + 1) * WIDTH]) for k in range(blocks)]
                arrays = [part.column(0), pa.array(close.astype(np.int32)), pa.array(gap), pa.array([r.tobytes() for r in x])]
                arrays += [pa.array([r.tobytes() for r in c], pa.binary()) for c in columns]
                names = ["vec_id", "list", "gap", "vector", *(f"dims_{k}" for k in range(blocks))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return index


def raw(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    """Equally long binary values as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def tail(z: np.ndarray) -> np.ndarray:
    """Close to the share of a normal distribution beyond ``z``."""
    z = np.clip(z, -8, 8)
    return 1 / (1 + np.exp(1.5976 * z + 0.070566 * z**3))


PLANNED = "query_id bigint, shard bigint, lists array<int>, tau double, vector binary"


def planner(lists: Lists, nearest: int, first: bool) -> Callable:
    """The Arrow task that chooses the lists a query probes: one row for each shard that holds some of them.

    First the lists with the best centers, until they hold ``FIRST`` times as many rows as neighbours are wanted. Then,
    with the threshold these gave, a normal distribution of the rows around each center tells how many hits to expect in
    each other list, and those are probed that hold all but ``MISS`` of them; all, if there is no threshold.
    """

    def chosen(score: np.ndarray, norm: float, tau: float) -> np.ndarray:
        order = np.argsort(-score, kind="stable")
        held = np.cumsum(lists.rows[order])
        begin = order[: int(np.searchsorted(held, FIRST * nearest + 1)) + 1]
        if first:
            return begin
        if tau == -np.inf:
            hits = lists.rows.astype(float)
        else:
            hits = lists.rows * tail((tau - score) / np.maximum(norm * lists.spread, 1e-300))
        others = hits.copy()
        others[begin] = -1
        order = np.argsort(-others, kind="stable")[: len(hits) - len(begin)]
        left = others[order].sum() - np.cumsum(others[order])
        needed = 0 if tau == -np.inf else MISS * hits.sum()
        count = int(np.searchsorted(-left, -needed)) + 1 if len(order) else 0
        found = order[:count]
        return found[lists.rows[found] > 0]

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x, tau = raw(part.column(1), "<f8"), part.column(2).to_numpy(zero_copy_only=False)
                scores, norms = x @ lists.centers.T, np.sqrt((x**2).sum(1))
                out: list[list] = [[] for _ in range(5)]
                for k, (query, vector) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    shards: dict[int, list[int]] = {}
                    for one in chosen(scores[k], norms[k], tau[k]).tolist():
                        for shard in range(lists.shard[one], lists.shard[one] + lists.shards[one]):
                            shards.setdefault(int(shard), []).append(one)
                    for shard, held in shards.items():
                        for column, value in zip(out, (query, shard, held, tau[k], vector), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.float64(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "shard", "lists", "tau", "vector"])

    return plan


class Scan:
    """The rows of a shard, ordered by list, and what its queries have found among them."""

    def __init__(self, rows: pa.Table, queries: pa.Table, turn: np.ndarray, blocks: int, nearest: int):
        order = np.argsort(rows.column("list").to_numpy(), kind="stable")
        self.ids = rows.column("vec_id").to_numpy()[order]
        self.list = rows.column("list").to_numpy()[order]
        self.x = raw(rows.column("vector"), "<f8")[order]
        self.parts = [raw(rows.column(f"dims_{k}"), "<f4")[order] for k in range(blocks)]
        self.norm = np.sqrt((self.x**2).sum(1))
        self.query_ids = queries.column("query_id").to_numpy()
        self.q = raw(queries.column("vector"), "<f8")
        turned = (self.q @ turn).astype("<f4")
        self.q_parts = [np.ascontiguousarray(turned[:, k * WIDTH : (k + 1) * WIDTH]) for k in range(blocks)]
        self.q_norm = np.sqrt((self.q**2).sum(1))
        self.tau = queries.column("tau").to_numpy().copy()
        self.dims, self.nearest = self.q.shape[1], nearest
        empty = np.zeros(0, np.int64)
        self.found = (empty, empty, np.zeros(0))  # query, id, score
        self.seen = np.zeros(blocks, np.int64)  # candidates that reached each block of columns

    def survivors(self, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs among these queries and rows that no test gives up."""
        low = np.where(np.isinf(self.tau), -1e300, self.tau)
        partial = self.q_parts[0][q] @ self.parts[0][x].T
        norms, done = self.q_norm[q][:, None] * self.norm[x], self.parts[0].shape[1]
        self.seen[0] += partial.size
        qi, xi = np.nonzero(partial >= self._least(low[q][:, None], norms, done))
        partial, norms, qi, xi = partial[qi, xi], norms[qi, xi], q[qi], x[xi]
        for k, part in enumerate(self.parts[1:], 1):
            self.seen[k] += len(qi)
            partial = partial + np.einsum("ij,ij->i", self.q_parts[k][qi], part[xi])
            done += part.shape[1]
            kept = partial >= self._least(low[qi], norms, done)
            partial, norms, qi, xi = partial[kept], norms[kept], qi[kept], xi[kept]
        other = self.query_ids[qi] != self.ids[xi]
        return qi[other], xi[other]

    def _least(self, tau: np.ndarray, norms: np.ndarray, done: int) -> np.ndarray:
        """What a row whose inner product is ``tau`` or more falls short of, after ``done`` dimensions, only by Z deviations."""
        share = done / self.dims
        deviation = np.sqrt(share * (1 - share) / self.dims)
        return tau * share - norms * (Z * deviation + ROUNDING)

    def probe(self, q: np.ndarray, x: np.ndarray) -> None:
        qi, xi = self.survivors(q, x)
        score = np.concatenate(
            [np.zeros(0), *((self.q[qi[k : k + 16384]] * self.x[xi[k : k + 16384]]).sum(1) for k in range(0, len(qi), 16384))]
        )
        held = np.isin(self.found[0], q)
        every = [np.concatenate([old[held], new]) for old, new in zip(self.found, (qi, self.ids[xi], score), strict=True)]
        rest = [old[~held] for old in self.found]
        query, ids, score = best(*every, self.nearest)
        ends = np.flatnonzero(np.append(query[1:] != query[:-1], True)) if len(query) else np.zeros(0, np.int64)
        full = ends[np.diff(np.append(-1, ends)) == self.nearest]
        self.tau[query[full]] = np.maximum(self.tau[query[full]], score[full])
        self.found = tuple(np.concatenate(pair) for pair in zip(rest, (query, ids, score), strict=True))

    def run(self, lists: pa.ChunkedArray) -> None:
        lists = lists.combine_chunks()
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        wanted = lists.flatten().to_numpy()
        order = np.argsort(wanted, kind="stable")
        for one in np.unique(wanted):
            rows = np.arange(*np.searchsorted(self.list, [one, one + 1]))
            queries = owner[order[slice(*np.searchsorted(wanted, [one, one + 1], sorter=order))]]
            for at in range(0, len(rows), 1024):
                some = rows[at : at + 1024]
                step = max(1, CELLS // len(some))
                for k in range(0, len(queries), step):
                    self.probe(queries[k : k + step], some)


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's nearest: highest scores, ties to the smaller id, an id once with its best score."""
    order = np.lexsort((-score, ids, query))
    query, ids, score = query[order], ids[order], score[order]
    new = np.append(True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]))[: len(query)]
    query, ids, score = query[new], ids[new], score[new]
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < nearest], ids[rank < nearest], score[rank < nearest]


FOUND = "query_id bigint, vec_id bigint, score double"


def scanner(turn: np.ndarray, blocks: int, nearest: int) -> Callable:
    """The cogrouped task: the rows of a shard and a bounded number of queries."""

    def scan(rows: pa.Table, queries: pa.Table) -> pa.Table:
        done = Scan(rows, queries, turn, blocks, nearest)
        if rows.num_rows and queries.num_rows:
            done.run(queries.column("lists"))
        query, ids, score = done.found
        return pa.table({"query_id": done.query_ids[query], "vec_id": ids, "score": score})

    return scan


def scanned(index: DataFrame, planned: DataFrame, lists: Lists, blocks: int, nearest: int) -> DataFrame:
    """What the planned queries find. Rows go once to each chunk of the queries that meet their shard."""
    spark = index.sparkSession
    planned = stored(spark, planned, "probes")
    chunks = planned.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    chunks = stored(spark, chunks, "chunks")
    rows = index.join(chunks, "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    queries = planned.join(chunks, "shard").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
    arrow_environment(spark)
    met = rows.drop("chunks").groupBy("shard", "chunk").cogroup(queries.drop("chunks").groupBy("shard", "chunk"))
    return stored(spark, met.applyInArrow(scanner(lists.turn, blocks, nearest), FOUND), "found")


def ranked(found: DataFrame, nearest: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)


def nearest_vectors(
    vectors: DataFrame, is_query: Column, nearest: int = NEAREST, ids: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of ``vectors`` to each of its rows that ``is_query`` names.

    ``is_query`` is a condition on ``vec_id``. Nearest is the largest inner product in double precision, ties to the smaller
    id; a row is no neighbour of its own id. Approximate: which rows are found, never their scores. Null, empty and zero
    vectors, null ids and vectors with null or non-finite components take no part; shorter vectors count as ending in
    zeros; rows of one id count as one, with its best score. Other columns are ignored, whatever their names; an empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, ids, column)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    blocks = -(-size.dims // WIDTH)
    lists = Lists(centers(rows, size.n, size.dims), rotation(size.dims))
    parts = ", ".join(f"dims_{k} binary" for k in range(blocks))
    schema = f"vec_id bigint, list int, gap double, vector binary, {parts}"
    placed = stored(spark, arrow_job(rows, indexer(lists, blocks), schema), "vectors")
    lists = lists.described(placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.avg("gap").alias("gap")).collect())
    places = [(k, int(s), int(n)) for k, (s, n) in enumerate(zip(lists.shard, lists.shards, strict=True))]
    # At most MOST_LISTS rows.
    places = F.broadcast(spark.createDataFrame(places, "list int, first bigint, many bigint"))
    shard = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("many"))
    index = placed.drop("gap").join(places, "list").withColumn("shard", shard).drop("first", "many")
    queries = placed.filter(is_query).select("vec_id", "vector").distinct()
    begin = queries.select("vec_id", "vector", F.lit(float("-inf")).alias("tau"))
    first = scanned(index, arrow_job(begin, planner(lists, nearest, True), PLANNED), lists, blocks, nearest)
    tau = ranked(first, nearest).filter(F.col("rank") == nearest).select(F.col("query_id").alias("vec_id"), "score")
    known = queries.join(tau, "vec_id", "left").select("vec_id", "vector", F.coalesce("score", F.lit(float("-inf"))).alias("tau"))
    second = scanned(index, arrow_job(known, planner(lists, nearest, False), PLANNED), lists, blocks, nearest)
    return ranked(first.union(second), nearest).select("query_id", "rank", "vec_id", "score")


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_vectors(vectors, F.col("vec_id") % 20 == 0)
