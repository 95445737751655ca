"""Operator 5: near-duplicates by SuperMinHash signatures, banding, exact verification and grouping.

SuperMinHash (Ertl, 2017): each element visits the places of the signature in a random order of its own and offers
its step number plus a random fraction; a place keeps the least offer. Offers of one element are correlated, which
lowers the variance, and an element can stop at a step that no place can gain from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm.arrays import GOLDEN, lists, mix, seeded, window_hashes
from colonnade.llm.common import arrow_job, documents, join_hot, lower_ascii, stored, task_count, words
from colonnade.llm.components import components

SHINGLE = 5
PERCENT = 75  # of the union that two sets must share
ROWS = 6  # places of a signature that must agree for two documents to meet
BANDS = 70  # a pair at the threshold meets nowhere with probability (1 - 0.75 ** 6) ** 70, about 1e-6
#: Pairs of an unsettled bucket whose signatures agree in less than this share aren't verified: nearly five standard
#: deviations below the threshold, so a link is lost here as rarely as by never meeting.
LEAST_LIKE = 0.65
ELEMENTS_AT_ONCE = 400_000
CENTERS_AT_ONCE = 2048  # of one bucket held by a task while all documents of the bucket stream past


def shingle_sets(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its windows of five words; a shorter row is one window."""
    n = len(values) - SHINGLE + 1
    hashes = window_hashes(values, np.arange(max(n, 0)), SHINGLE)
    found = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - begin >= SHINGLE:
            found.append(np.unique(hashes[begin : end - SHINGLE + 1]))
        elif end > begin:
            found.append(window_hashes(values[begin:end], np.zeros(1, np.int64), end - begin, seed=end - begin))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def superminhash(elements: np.ndarray, owner: np.ndarray, signatures: np.ndarray) -> None:
    """Offer the elements (hashes) to the signatures of the rows they belong to, in place.

    An entry is ``step << 32 | fraction``. All elements take step j together; rows whose largest entry is below
    j << 32 can't gain any more and drop out, so large sets need two or three steps.
    """
    places = signatures.shape[1]
    flat = signatures.reshape(-1)
    chosen: list[np.ndarray] = []  # place each live element swapped with at each earlier step
    for step in range(places):
        if not len(elements):
            return
        drawn = mix(elements + seeded(step + 1))
        low = drawn & np.uint64(0xFFFFFFFF)
        swap = step + ((low * np.uint64(places - step)) >> np.uint64(32)).astype(np.int64)
        place = swap.copy()
        for earlier in range(step - 1, -1, -1):
            place[chosen[earlier] == place] = earlier
        offer = (np.uint64(step) << np.uint64(32)) | (drawn >> np.uint64(32))
        np.minimum.at(flat, owner * places + place, offer)
        chosen.append(swap)
        rows = np.unique(owner)
        open_rows = np.zeros(len(signatures), bool)
        open_rows[rows] = signatures[rows].max(axis=1) >= np.uint64((step + 1) << 32)
        live = open_rows[owner]
        if not live.all():
            elements, owner, chosen = elements[live], owner[live], [c[live] for c in chosen]


def signatures_of(sets: list[np.ndarray], places: int) -> np.ndarray:
    out = np.full((len(sets), places), np.uint64(0xFFFFFFFFFFFFFFFF))
    elements = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for begin in range(0, len(elements), ELEMENTS_AT_ONCE):
        part = slice(begin, begin + ELEMENTS_AT_ONCE)
        superminhash(elements[part], owner[part], out)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band of the signature and its number."""
    bands = signatures.shape[1] // rows
    keys = np.empty((len(signatures), bands), np.uint64)
    for band in range(bands):
        total = np.full(len(signatures), seeded(band + 1))
        for i in range(band * rows, (band + 1) * rows):
            total = mix(total + signatures[:, i] * GOLDEN)
        keys[:, band] = total
    return keys


SKETCH = "id bigint, n_shingles bigint, set_key binary, bands array<bigint>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            part = batch.slice(begin, 1000)
            sets = shingle_sets(*lists(part.column(1)))
            keys = band_keys(signatures_of(sets, ROWS * BANDS), ROWS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, keys.reshape(-1)),
                ],
                names=["id", "n_shingles", "set_key", "bands"],
            )


SETS = "id bigint, members binary, sketch binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets, and signatures cut to a byte a place with band keys cut to four bytes."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            part = batch.slice(begin, 1000)
            sets = shingle_sets(*lists(part.column(1)))
            signatures = signatures_of(sets, ROWS * BANDS)
            keys = band_keys(signatures, ROWS).astype("<u4")
            small = mix(signatures.copy()).astype(np.uint8)
            sketches = [one.tobytes() + key.tobytes() for one, key in zip(small, keys, strict=True)]
            arrays = [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "members", "sketch"])


MEETS = "bucket bigint, band int, node bigint, lo bigint"


def _meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by bucket and node those whose bucket has several, with the smallest node of the bucket.

    Memory holds a batch and what the last bucket needs; a bucket that lies in several partitions has a smallest
    node in each. A single row in a partition's first or last bucket is kept: the rest may lie in the next one.
    """

    def rows(bucket, band, node, lo):
        arrays = [pa.array(bucket), pa.array(band.astype(np.int32)), pa.array(node), pa.array(lo)]
        return pa.RecordBatch.from_arrays(arrays, names=["bucket", "band", "node", "lo"])

    empty = np.zeros(0, np.int64)
    held, last, low = (empty, empty, empty), None, None  # a bucket's only row so far; the open bucket and its lowest
    edge = None  # the partition's first bucket
    for batch in batches:
        bucket, band, node = (
            np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)
        )
        if not len(bucket):
            continue
        firsts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        counts = np.diff(firsts, append=len(bucket))
        lows, several = node[firsts].copy(), counts > 1
        edge = bucket[0] if edge is None else edge
        if last is not None and bucket[0] == last:
            lows[0], several[0] = low, True
        if len(several) > 1 and bucket[0] == edge:
            several[0] = True
        if not several[-1]:
            held, last, low = (bucket[-1:], band[-1:], node[-1:]), None, None
        else:
            held, last, low = (empty, empty, empty), bucket[-1], lows[-1]
        keep = np.repeat(several, counts)
        yield rows(bucket[keep], band[keep], node[keep], np.repeat(lows, counts)[keep])
    if len(held[0]):
        yield rows(*held, held[2])


CANDIDATES = "a bigint, b bigint"


def candidate_finder(least_like: float) -> Callable:
    """The Arrow task that gives, from rows sorted by bucket, centers first, pairs that may be linked.

    A pair that meets in several bands is given out in the first of them. With ``least_like`` 0 signatures and bands
    are not looked at: every pair of a center and another document of its bucket is given out.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = ROWS * BANDS
        current, centers, ready = None, [], None
        for batch in batches:
            pairs = []
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for i, (bucket, chunk, kind, node, component, band, main) in enumerate(zip(*columns, strict=True)):
                if (bucket, chunk) != current:
                    current, centers, ready = (bucket, chunk), [], None
                data = np.frombuffer(batch.column(7)[i].as_buffer(), np.uint8)
                size = batch.column(8)[i].as_py()
                small, keys = data[:places], data[places:].view("<u4")
                if kind == 0:
                    centers.append((node, component, size, small, keys))
                    continue
                if ready is None:
                    ready = [np.array(c) for c in zip(*centers, strict=True)] if centers else []
                if not ready:
                    continue
                nodes, parts, sizes, all_small, all_keys = ready
                fits = (parts != component) & (100 * np.minimum(sizes, size) >= PERCENT * np.maximum(sizes, size))
                if component != main:  # it is a center too, so the pair comes up twice
                    fits &= nodes < node
                at = np.flatnonzero(fits)
                if least_like > 0:
                    like = ((all_small[at] == small).mean(axis=1) - 1 / 256) * (256 / 255)
                    at = at[like >= least_like]
                    if len(at):
                        at = at[np.argmax(all_keys[at] == keys, axis=1) == band]
                pairs += [(min(n, node), max(n, node)) for n in nodes[at].tolist()]
            first, second = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["a", "b"])

    return candidates


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with their two sets: which share enough."""
    for batch in batches:
        linked = []
        for one, other in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, other))
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
        )


def word_hashes(text):
    return F.transform(words(lower_ascii(text)), lambda word: F.xxhash64(word))


def near_duplicates(spark: SparkSession, docs: DataFrame, least_like: float = LEAST_LIKE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id``, ``text``).

    Documents with equal sets are one class, represented by its smallest id; only representatives are banded.
    In a bucket the smallest document is compared with all others. In buckets that then still hold several
    components every document outside the largest of them is compared with all others: by signatures, while the
    bucket streams through a task, and what is similar enough by whole sets (of 64-bit hashes). So no bucket is cut
    short, and no bucket puts out all its pairs. With ``least_like`` 0 nothing is left to the signatures in such buckets:
    every such pair that shares a bucket is verified, which loses no link there and costs as many set comparisons.

    Documents without words (null, empty, blank) link with nothing. Rows with a null doc_id link with nothing and
    are kept. Rows that share a doc_id are one document. Other columns are ignored, an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    hashed = texts.select("id", word_hashes(F.col("text")).alias("hashes"))
    sketch = stored(spark, arrow_job(hashed, _sketch, SKETCH), "sketches")
    filled = sketch.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = filled.groupBy("set_key").agg(F.min("id").alias("node"), F.first("bands").alias("bands"))
    labels = _labels(spark, texts, classes, least_like)
    nodes = filled.groupBy("set_key").agg(F.min("id").alias("node"))
    group = (
        join_hot(filled.select("id", "set_key"), nodes, "set_key", "id")
        .join(labels, "node", "left")
        .groupBy("id")
        .agg(F.min(F.coalesce("component", "node")).alias("component"))
    )
    component = F.coalesce("component", "id")
    return sketch.join(group, "id", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _labels(spark: SparkSession, texts: DataFrame, classes: DataFrame, least_like: float) -> DataFrame:
    """``node, component`` of the representatives that are linked."""
    banded = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    # Ranges of bucket and node cut a hot bucket into several partitions.
    ranged = banded.select("bucket", F.col("band").cast("bigint").alias("band"), "node").repartitionByRange(
        task_count(spark), "bucket", "node"
    )
    meets = stored(spark, arrow_job(ranged.sortWithinPartitions("bucket", "node"), _meets, MEETS), "buckets")
    wanted = texts.join(meets.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    hashed = wanted.select("id", word_hashes(F.col("text")).alias("hashes"))
    sets = stored(spark, arrow_job(hashed, _sets, SETS), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        first = sets.select(F.col("id").alias("a"), F.col("members").alias("one"))
        second = sets.select(F.col("id").alias("b"), F.col("members").alias("other"))
        size, other = F.octet_length("one"), F.octet_length("other")
        whole = pairs.join(second, "b").join(first, "a").filter(
            100 * F.least(size, other) >= PERCENT * F.greatest(size, other)
        )
        found = arrow_job(whole.select("a", "b", "one", "other"), _verified, "a bigint, b bigint, linked boolean")
        return stored(spark, found.filter("linked").select("a", "b"), "linked")

    pairs = meets.filter("lo <> node").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct()
    links = linked(pairs)
    rest = _unsettled(spark, meets, components(spark, links), sets, least_like)
    return components(spark, links.union(linked(rest.join(pairs, ["a", "b"], "left_anti"))))


def _unsettled(spark: SparkSession, meets: DataFrame, labels: DataFrame, sets: DataFrame,
               least_like: float) -> DataFrame:
    """Pairs ``a, b`` of documents of one bucket and of different components whose signatures are similar.

    Two documents of different components are not both in the bucket's largest one, so it is enough to compare
    every document outside that with all. Where these are many, they are held by several tasks, and the bucket
    streams past each.
    """
    rows = meets.select("bucket", "band", "node").join(labels, "node", "left")
    rows = rows.select("bucket", "band", "node", F.coalesce("component", "node").alias("component"))
    sizes = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"),
        F.max_by("component", F.struct("n", "component")).alias("main"),
        (F.sum("n") - F.max("n")).alias("n_centers"),
    )
    open_ = stored(spark, rows.join(mixed.filter("parts > 1").drop("parts"), "bucket"), "open")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("node")) - 1
    centers = open_.filter("component <> main").withColumn("chunk", F.floor(rank / CENTERS_AT_ONCE))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_centers") - 1) / CENTERS_AT_ONCE))
    others = open_.withColumn("chunk", F.explode(chunks))
    columns = ["bucket", "chunk", "kind", "node", "component", "band", "main"]
    both = centers.withColumn("kind", F.lit(0)).select(columns).union(
        others.withColumn("kind", F.lit(1)).select(columns)
    )
    known = sets.select(F.col("id").alias("node"), "sketch", (F.octet_length("members") / 8).cast("int").alias("n"))
    dealt = both.join(known, "node").select(*columns, "sketch", "n")
    dealt = dealt.repartition(task_count(spark), "bucket", "chunk")
    ordered = dealt.sortWithinPartitions("bucket", "chunk", "kind", "node")
    return arrow_job(ordered, candidate_finder(least_like), CANDIDATES).distinct()


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, documents(spark, sf_dir))


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS shingle
  FROM d WHERE len(ws) > 0
), sizes AS (
  SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id
), shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.r, b.r
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shared JOIN sizes x ON shared.a = x.r JOIN sizes y ON shared.b = y.r
  WHERE 100 * shared.n >= {PERCENT} * (x.n + y.n - shared.n)
), links AS (
  SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reached AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
), groups AS (
  SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(d.doc_id = coalesce(component, d.doc_id), true) AS kept
FROM d LEFT JOIN sizes USING (r) LEFT JOIN groups ON groups.doc_id = d.doc_id
"""
