"""Operator 4: substring dedup by fixed-block anchors.

Every document is cut into non-overlapping blocks of 25 words: the index. Every rolling window of 25 words probes it. A
repeat of 50 words holds a whole block of the document it repeats, so it leaves a hit at the right distance. Around the
hits all windows of 50 words are compared by 64-bit hashes; those that a smaller document holds too join up to the
maximal exact repeats, and their words go.

Both comparisons deal hashes out to buckets. What a task sends to a bucket is packed into one row of arrays, and a
bucket's rows stream through one task in order: first what builds its table, then what is looked up in it. Memory is
bounded by the distinct hashes of a bucket, not by how often one occurs.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.arrays import lists, mix, owners, seeded, window_hashes, window_starts
from colonnade.llm.common import arrow_job, bind, documents, join_hot, stored, task_count, words

WINDOW = 50
BLOCK = WINDOW // 2  # two blocks fit in any window, so one of them is whole wherever the window begins
WORDS_AT_ONCE = 3_000_000
ROWS = "bucket int, kind int, payload binary"
TABLE, PROBE, ANSWER, KNOWN = 0, 1, 2, 3


# ---- arrays of (document, place, hash), packed ------------------------------------------------------------


def pack(ids: np.ndarray, counts: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> bytes:
    """Documents (a row of numbers each), how many entries each has, their places (rising) and their hashes.

    Numbers that are near to each other are kept as differences of one or two bytes, with an escape for large ones.
    """
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    steps = np.diff(places, prepend=0).astype(np.int64)
    steps[firsts] = places[firsts]
    width = 1 if np.count_nonzero(steps >= 255) * 4 < len(steps) else 2
    escape = (1 << 8 * width) - 1
    small = np.minimum(steps, escape).astype(f"<u{width}")
    large = steps[steps >= escape].astype("<u4")
    id_steps = np.diff(ids, axis=0, prepend=np.zeros((1, ids.shape[1]), np.int64))
    head = struct.pack("<6q", len(ids), ids.shape[1], len(places), len(large), hashes.itemsize, width)
    arrays = (id_steps.T.copy(), counts.astype("<u4"), large, hashes, small)
    return head + b"".join(a.tobytes() for a in arrays)


def unpack(payload: memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n_ids, width, n, n_large, size, step = struct.unpack_from("<6q", payload, 0)
    at = 48

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(payload, kind, count, at)
        at += found.nbytes
        return found

    ids = np.cumsum(take("<i8", n_ids * width).reshape(width, n_ids), axis=1).T
    counts, large = take("<u4", n_ids).astype(np.int64), take("<u4", n_large)
    hashes, steps = take(f"<u{size}", n), take(f"<u{step}", n).astype(np.int64)
    steps[steps == (1 << 8 * step) - 1] = large
    total = np.cumsum(steps)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    places = total - np.repeat(total[firsts] - steps[firsts], counts)
    return ids, counts, places, hashes


def by_bucket(
    bucket: np.ndarray, owner: np.ndarray, places: np.ndarray, hashes: np.ndarray, ids: np.ndarray
) -> Iterator[tuple[int, bytes]]:
    """The entries of each bucket, packed; entries come in the order of owner and place."""
    if not len(bucket):
        return
    order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 1 << 16 else bucket, kind="stable")
    bucket, owner, places, hashes = bucket[order], owner[order], places[order], hashes[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for begin, end in zip(edges, [*edges[1:], len(bucket)], strict=True):
        mine = owner[begin:end]
        firsts = np.flatnonzero(np.diff(mine, prepend=-1))
        counts = np.diff(firsts, append=len(mine))
        yield int(bucket[begin]), pack(ids[mine[firsts]], counts, places[begin:end], hashes[begin:end])


def as_rows(packed: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*packed, strict=True)) or [(), (), ()]
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "kind", "payload"])


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the lists of one piece hold some millions of values at most, or one row."""
    for batch in batches:
        ends = batch.column(column).offsets.to_numpy().astype(np.int64)
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + WORDS_AT_ONCE, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


class Smallest:
    """Distinct hashes with the smallest document that holds each, and the largest one seen to ask for it."""

    def __init__(self):
        self.keys, self.least = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.most: np.ndarray | None = None

    def add(self, hashes: np.ndarray, docs: np.ndarray) -> None:
        self.waiting.append((hashes.astype(np.uint64), docs))
        self.held += len(hashes)
        if self.held > max(500_000, len(self.keys)):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(h for h, _ in self.waiting)])
        docs = np.concatenate([self.least, *(d for _, d in self.waiting)])
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        self.keys, self.least = keys[firsts], np.minimum.reduceat(docs, firsts) if len(firsts) else docs
        self.waiting, self.held = [], 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are held, and their numbers."""
        if self.waiting:
            self.settle()
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = hashes.astype(np.uint64)
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == hashes)
        return hit, at[hit]

    def asked(self, at: np.ndarray, docs: np.ndarray) -> None:
        if self.most is None:
            self.most = np.full(len(self.keys), np.iinfo(np.int64).min)
        np.maximum.at(self.most, at, docs)


def answers(width: int) -> Callable:
    """The Arrow task that streams sorted bucket rows: the documents' numbers and the places that were hit.

    ``repeats`` are places whose hash a smaller document holds, ``asked`` those whose hash a larger one asks for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, table = None, Smallest()
        for batch in batches:
            for bucket, kind, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                if bucket.as_py() != current:
                    current, table = bucket.as_py(), Smallest()
                ids, counts, places, hashes = unpack(memoryview(payload.as_buffer()))
                docs = np.repeat(ids[:, 0], counts)
                if kind.as_py() == TABLE:
                    table.add(hashes, docs)
                    continue
                hit, at = (np.arange(len(docs)), None) if kind.as_py() == KNOWN else table.find(hashes)
                if kind.as_py() == KNOWN:
                    pass
                elif kind.as_py() == PROBE:
                    table.asked(at, docs[hit])
                    hit = hit[table.least[at] < docs[hit]]
                else:
                    asked = table.most[at] if table.most is not None else np.zeros(0, np.int64)
                    hit = hit[: len(asked)][asked > docs[hit[: len(asked)]]]
                if len(hit):
                    owner = np.repeat(np.arange(len(ids)), counts)[hit]
                    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
                    edges = np.append(firsts, len(hit)).astype(np.int32)
                    found = pa.ListArray.from_arrays(edges, pa.array(places[hit].astype(np.int32)))
                    nothing = pa.nulls(len(firsts), found.type)
                    both = [nothing, found] if kind.as_py() == ANSWER else [found, nothing]
                    numbers = [pa.array(ids[owner[firsts], k]) for k in range(width)]
                    names = ["doc_id", "version"][:width]
                    yield pa.RecordBatch.from_arrays([*numbers, *both], names=[*names, "repeats", "asked"])

    return run


def streamed(frame: DataFrame, width: int) -> DataFrame:
    """The bucket rows, each bucket to one task in the order of kinds, and what that task answers."""
    spark = frame.sparkSession
    dealt = frame.repartitionById(task_count(spark), "bucket").sortWithinPartitions("bucket", "kind")
    numbers = ["doc_id bigint", "version bigint"][:width]
    return arrow_job(dealt, answers(width), ", ".join([*numbers, "repeats array<int>", "asked array<int>"]))


# ---- hits of blocks ---------------------------------------------------------------------------------------


def block_rows(buckets: int) -> Callable:
    """The Arrow task that sends every document's blocks and rolling windows to their buckets.

    Here 32 bits of a hash are kept beside its bucket. A false hit costs some windows that are compared in vain. Of
    equal texts that a task holds at once only the smallest document is sent: the others are copies of it, which
    their digests settle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            if not part.num_rows:
                continue
            docs, versions = (part.column(i).to_numpy() for i in (0, 1))
            order = np.lexsort((docs, versions))
            first = np.concatenate([[True], np.diff(versions[order]) != 0])
            smallest = np.sort(order[first])
            part = part.take(pa.array(smallest)) if len(smallest) < len(docs) else part
            values, offsets = lists(part.column(2))
            starts = window_starts(offsets, BLOCK)
            if not len(starts):
                continue
            hashes = window_hashes(values, starts, BLOCK)
            owner = owners(offsets)[starts]
            places = starts - offsets[owner]
            bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            short = hashes.astype(np.uint32)
            ids = part.column(0).to_numpy()[:, None]
            aligned = places % BLOCK == 0
            block = [x[aligned] for x in (bucket, owner, places, short)]
            for number, payload in by_bucket(*block, ids):
                yield as_rows([(number, TABLE, payload), (number, ANSWER, payload)])
            for number, payload in by_bucket(bucket, owner, places, short, ids):
                yield as_rows([(number, PROBE, payload)])

    return run


def anchors(docs: DataFrame) -> DataFrame:
    """``doc_id, repeats, asked``: where windows of 25 words begin that a smaller document has as a block, and where
    blocks begin that a larger document has a window like."""
    spark = docs.sparkSession
    rows = arrow_job(docs.select("doc_id", "version", "hashes"), block_rows(task_count(spark)), ROWS)
    return streamed(rows, 1)


# ---- windows around the hits ------------------------------------------------------------------------------


def around(hits: pa.ListArray, offsets: np.ndarray, size: int) -> np.ndarray:
    """For each word of the rows end to end: may a window that starts here hold one of the row's hits whole?"""
    found, hit_offsets = lists(hits)
    begins = offsets[owners(hit_offsets)]
    marks = np.zeros(size + 2, np.int64)
    np.add.at(marks, np.maximum(found + begins - BLOCK, begins), 1)
    np.add.at(marks, found + begins + 1, -1)
    return np.cumsum(marks)[:size] > 0


def window_rows(buckets: int) -> Callable:
    """The Arrow task that sends the windows of 50 words around the hits to their buckets, hash and all.

    Windows that a larger document may hold build the tables, those that a smaller one may hold look them up. What
    a task can see itself isn't looked up: of equal windows it sends the smallest document's, the larger ones' are
    known repeats, which go along without hashes. So a window that very many documents hold counts once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            values, offsets = lists(part.column(2))
            every = window_starts(offsets, WINDOW)
            ids = np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()], axis=1)
            near = [around(part.column(k), offsets, len(values)) for k in (4, 3)]  # asked for, maybe repeats
            starts = every[(near[0] | near[1])[every]]
            if not len(starts):
                continue
            hashes, owner = window_hashes(values, starts, WINDOW), owners(offsets)[starts]
            docs, places = ids[owner, 0], starts - offsets[owner]
            # Of equal windows the smallest document's comes first.
            order = np.lexsort((starts, docs, hashes))
            first = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
            least = np.empty(len(docs), np.int64)
            least[order] = docs[order[first]][np.cumsum(first) - 1]
            asked, maybe = near[0][starts], near[1][starts]
            known = maybe & (least < docs)
            sent = asked[order]
            group = np.cumsum(first)[sent]
            table = order[sent][np.flatnonzero(np.diff(group, prepend=0))]
            spread = mix(hashes ^ seeded(7))
            bucket = ((spread >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            for kind, at in ((TABLE, np.sort(table)), (PROBE, np.flatnonzero(maybe & ~known))):
                for number, payload in by_bucket(bucket[at], owner[at], places[at], hashes[at], ids):
                    yield as_rows([(number, kind, payload)])
            at = np.flatnonzero(known)
            one = np.full(len(at), int(hashes[0] % np.uint64(buckets)), np.int32)
            for number, payload in by_bucket(one, owner[at], places[at], np.zeros(len(at), np.uint8), ids):
                yield as_rows([(number, KNOWN, payload)])

    return run


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def remove_repeats(spark: SparkSession, docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the text of each row of ``docs`` without repeats of 50 words or more.

    A word goes if a window of 50 consecutive words that covers it also starts in a document with a smaller id.
    ``kept`` joins the other words by one blank; with ``digest`` it is their SHA-256. Null and blank texts have no words. Rows with a null doc_id lose
    nothing and no other row loses for them; rows that share a doc_id are one document and lose nothing for each
    other. Other columns are ignored, an empty table gives no rows.

    Exact copies are found by their digests; only the smallest of them goes through the comparison of windows.
    """
    version = F.xxhash64(F.coalesce("text", F.lit("")))
    known = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    hits = anchors(known.select("doc_id", version.alias("version"), word_hashes(F.col("text")).alias("hashes")))
    whole = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    digests = known.select("doc_id", whole.alias("digest"), version.alias("version"))
    least = digests.groupBy("digest").agg(F.min("doc_id").alias("least"))
    copies = join_hot(digests, least, "digest", "doc_id").filter("least < doc_id").select("doc_id", "version")
    none = F.lit(None)
    marks = (
        hits.withColumn("version", none.cast("bigint"))
        .unionByName(copies.withColumns({name: none.cast("array<int>") for name in ("repeats", "asked")}))
        .groupBy("doc_id")
        .agg(
            *(F.flatten(F.collect_list(name)).alias(name) for name in ("repeats", "asked")),
            F.collect_set("version").alias("copies"),
        )
    )
    packed = arrow_job(docs.select("doc_id", version.alias("version"), F.coalesce("text", F.lit("")).alias("text")),
                       _compress, "doc_id bigint, version bigint, text binary")
    joined = packed.join(marks, "doc_id", "left").select(
        "doc_id", "version", "text",
        *(F.coalesce(name, F.array().cast("array<int>")).alias(name) for name in ("repeats", "asked")),
        F.coalesce(F.array_contains("copies", F.col("version")), F.lit(False)).alias("is_copy"),
    )
    halfway = stored(spark, arrow_job(joined, settler(digest), HALFWAY), "passages")
    row = F.struct("doc_id", "version").alias("row")
    open_ = halfway.filter("is_open").select(row, "repeats", "asked", "kept")
    entries = open_.select(
        "row.doc_id", "row.version", word_hashes(F.col("kept")).alias("hashes"), "repeats", "asked"
    )
    repeats = streamed(arrow_job(entries, window_rows(task_count(spark)), ROWS), 2)
    starts = (
        repeats.groupBy(F.struct("doc_id", "version").alias("row"))
        .agg(F.array_sort(F.flatten(F.collect_list("repeats"))).alias("starts"))
    )
    done = open_.select("row", "kept").join(starts, "row", "left")
    places = F.coalesce("starts", F.array().cast("array<int>"))
    parted = bind(words(F.col("kept")), lambda w: F.struct(F.size(w).alias("n"), uncovered(w, places).alias("left")))
    done = done.select("row", parted.alias("parted"))
    text = F.array_join("parted.left", " ")
    done = done.select(
        "row", F.col("parted.n").cast("bigint").alias("n_words"),
        (F.col("parted.n") - F.size("parted.left")).cast("bigint").alias("n_removed"),
        (F.sha2(text, 256) if digest else text).alias("kept"),
    )
    settled_rows = halfway.filter("NOT is_open").select(row, "n_words", "n_removed", "kept")
    return settled_rows.unionByName(done).select("row.doc_id", "n_words", "n_removed", "kept")


HALFWAY = (
    "doc_id bigint, version bigint, is_open boolean, repeats array<int>, asked array<int>, n_words bigint, "
    "n_removed bigint, kept string"
)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts smaller, before they are shuffled."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = pa.array([compressor.compress(text.as_buffer()) for text in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], texts], names=["doc_id", "version", "text"])


def settler(digest: bool) -> Callable:
    """The Arrow task that settles documents without hits, and copies of a smaller document; others stay open.

    An open document keeps its words, joined by one blank, and its hits.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                opened, counts, removed, kept = [], [], [], []
                hits = zip(part.column(3), part.column(4), part.column(5), strict=True)
                for text, (repeats, asked, is_copy) in zip(part.column(2), hits, strict=True):
                    found = expand.decompress(text.as_buffer()).split()  # bytes split at just the six blanks
                    gone = len(found) if is_copy.as_py() and len(found) >= WINDOW else 0
                    hit = not is_copy.as_py() and len(found) >= WINDOW and len(repeats) + len(asked) > 0
                    words_left = b"" if gone else b" ".join(found)
                    if digest and not hit:
                        words_left = hashlib.sha256(words_left).hexdigest().encode()
                    opened.append(hit)
                    counts.append(len(found))
                    removed.append(gone)
                    kept.append(words_left.decode())
                flag = pa.array(opened, pa.bool_())
                empty = pa.array([[]] * len(opened), pa.list_(pa.int32()))
                lists_ = [pc.if_else(flag, part.column(k), empty) for k in (3, 4)]
                arrays = [*part.columns[:2], flag, *lists_, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                          pa.array(kept, pa.string())]
                names = [c.split()[0] for c in HALFWAY.split(", ")]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return settle


def uncovered(found: Column, starts: Column) -> Column:
    """The words that no window of 50 covers; the windows' starts come in rising order."""
    edges = F.concat(F.array(F.lit(-WINDOW)), starts, F.array(F.size(found)))

    def between(edge: Column, i: Column, all_: Column) -> Column:
        return F.slice(found, edge + WINDOW + 1, F.greatest(all_[i + 1] - edge - WINDOW, F.lit(0)))

    return bind(
        edges,
        lambda e: F.flatten(
            F.transform(F.slice(e, 1, F.size(e) - 1), lambda edge, i: between(edge, i, e))
        ),
    )


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(spark, documents(spark, sf_dir), digest=True)
    return done.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), w AS (
  SELECT r, doc_id, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS passage
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)
), held AS (
  SELECT r, i, coalesce(min(doc_id) OVER (PARTITION BY passage) < doc_id, false) AS repeated FROM w
), p AS (
  SELECT r, doc_id, i, ws[i] AS word FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)
), marked AS (
  SELECT p.r, p.i, word, bool_or(coalesce(repeated, false)) OVER (
    PARTITION BY p.r ORDER BY p.i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS lost
  FROM p LEFT JOIN held ON p.r = held.r AND p.i = held.i
)
SELECT doc_id, count(i) AS n_words, count(i) FILTER (WHERE lost) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM d LEFT JOIN marked USING (r) GROUP BY r, doc_id
"""
