"""Operator 3: packing. First-fit decreasing over a tournament tree, in randomised groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_job, documents, task_count
from colonnade.llm.tokens import encoder, text_slices, tokenizer_path

LENGTH = 1024
END_ID = 0
GROUP_DOCUMENTS = 4096
GROUP_TOKENS = 4_000_000  # a group ends with the document that reaches this
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids array<int>"
)


class Tournament:
    """Free room of bins in the order they were opened; each inner node knows the most room below it."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves, self.bins = capacity, 1, 0
        self.room = [0, 0]

    def _open(self) -> int:
        if self.bins == self.leaves:
            old = self.room[self.leaves :]
            self.leaves *= 2
            self.room = [0] * self.leaves + old + [0] * (self.leaves - len(old))
            for node in range(self.leaves - 1, 0, -1):
                self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])
        self.bins += 1
        self._set(self.bins - 1, self.capacity)
        return self.bins - 1

    def _set(self, number: int, room: int) -> None:
        node = self.leaves + number
        self.room[node] = room
        while node > 1:
            node //= 2
            best = max(self.room[2 * node], self.room[2 * node + 1])
            if self.room[node] == best:
                break
            self.room[node] = best

    def place(self, size: int) -> int:
        """The first bin with room for ``size``, opened if there is none; its room shrinks."""
        if self.room[1] < size:
            number = self._open()
        else:
            node = 1
            while node < self.leaves:
                node *= 2
                if self.room[node] < size:
                    node += 1
            number = node - self.leaves
        self._set(number, self.room[self.leaves + number] - size)
        return number


@dataclass
class Group:
    """Documents of one group by number, with their lengths."""

    sizes: list[int] = field(default_factory=list)

    def pack(self, length: int) -> list[list[tuple[int, int, int]]]:
        """Sequences as lists of (document, start, size).

        A document gives as many full sequences as it can; the rests are packed first-fit decreasing. Then the
        emptiest sequences are taken apart to fill the gaps of the others, cutting pieces where needed. What the
        last one holds becomes sequences of powers of two, so that nothing needs padding.
        """
        done: list[list[tuple[int, int, int]]] = []
        rests = []
        for number, size in enumerate(self.sizes):
            full = size // length
            done += [[(number, k * length, length)] for k in range(full)]
            if size % length:
                rests.append((number, full * length, size % length))
        tree, bins = Tournament(length), []
        for piece in sorted(rests, key=lambda p: (-p[2], p[0])):
            at = tree.place(piece[2])
            if at == len(bins):
                bins.append([])
            bins[at].append(piece)
        fill = [sum(p[2] for p in b) for b in bins]
        order = sorted((k for k in range(len(bins)) if fill[k] < length), key=lambda k: (-fill[k], k))
        done += [bins[k] for k in range(len(bins)) if fill[k] == length]
        donor = len(order) - 1
        for at, k in enumerate(order):
            while at < donor and fill[k] < length:
                source = bins[order[donor]]
                number, start, size = source.pop()
                take = min(size, length - fill[k])
                bins[k].append((number, start, take))
                fill[k] += take
                if take < size:
                    source.append((number, start + take, size - take))
                if not source:
                    donor -= 1
            if at >= donor:
                if at == donor:
                    done += powers_of_two(bins[k])
                break
            done.append(bins[k])
        return done


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces cut into sequences whose sizes are the powers of two their sum is made of."""
    left = sum(size for _, _, size in pieces)
    queue, out = list(reversed(pieces)), []
    while left:
        need = 1 << (left.bit_length() - 1)
        left -= need
        one = []
        while need:
            number, start, size = queue.pop()
            take = min(size, need)
            one.append((number, start, take))
            if take < size:
                queue.append((number, start + take, size - take))
            need -= take
        out.append(one)
    return out


COLUMNS = [field.split()[0] for field in PIECES.split(", ")]
PIECES_AT_ONCE = 4096  # rows of a batch that is sent on


class Ids:
    """Ids of a group of documents, end to end in little-endian 32-bit numbers."""

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.held: list[np.ndarray] = []
        self.tokens = 0

    def add(self, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.sizes += sizes
        self.held.append(ids)
        self.tokens += len(ids)

    def pieces(self, length: int, first: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
        """The packed pieces in batches; sequences are numbered from ``first``."""
        packed = Group(self.sizes).pack(length)
        flat = np.array([piece for sequence in packed for piece in sequence], np.int64).reshape(-1, 3)
        number, start, size = flat.T
        counts = np.array([len(sequence) for sequence in packed], np.int64)
        sequence = np.repeat(np.arange(first, first + len(packed)), counts)
        before = np.cumsum(size) - size
        offset = before - np.repeat(before[np.cumsum(counts) - counts], counts)
        ids = np.concatenate(self.held).astype("<u4")
        self.held = []
        sizes = np.array(self.sizes, np.int64)
        begin = (np.cumsum(sizes) - sizes)[number] + start
        doc_ids = pa.array(self.doc_ids, pa.int64())
        data = memoryview(ids).cast("B")
        for at in range(0, len(flat), PIECES_AT_ONCE):
            some = slice(at, at + PIECES_AT_ONCE)
            spans = list(zip(begin[some].tolist(), size[some].tolist(), strict=True))
            crc = [zlib.crc32(data[4 * b : 4 * (b + n)]) for b, n in spans]
            if with_ids:
                values = np.concatenate([ids[b : b + n] for b, n in spans]).astype(np.int32)
                ends = np.append(0, np.cumsum(size[some])).astype(np.int32)
                kept = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            else:
                kept = pa.nulls(len(spans), pa.list_(pa.int32()))
            columns = (start[some], size[some], crc, sizes[number[some]], sequence[some], offset[some])
            arrays = [doc_ids.take(pa.array(number[some])), *(pa.array(c, pa.int64()) for c in columns), kept]
            yield pa.RecordBatch.from_arrays(arrays, names=COLUMNS)


def packer(path: str, length: int, end_id: int, with_ids: bool, special_as_text: bool):
    """The Arrow task: takes document ids and texts in random order, packs a bounded group at a time."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, group = encoder(path, special_as_text), Ids()
        following = TaskContext.get().partitionId() << 40

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal group, following
            for out in group.pieces(length, following, with_ids):
                last = out.column(COLUMNS.index("sequence_id"))[-1].as_py()
                yield out
            group, following = Ids(), last + 1

        for batch in batches:
            for some in text_slices(batch, 1):
                ids, ends = encode.encode(some.column(1))
                ids = np.insert(ids, ends[1:], end_id)
                ends += np.arange(len(ends))
                doc_ids, sizes, at = some.column(0).to_pylist(), np.diff(ends), 0
                while at < len(doc_ids):
                    room = GROUP_TOKENS - group.tokens + ends[at]
                    fit = min(int(np.searchsorted(ends, room, "left")), at + GROUP_DOCUMENTS - len(group.sizes), len(doc_ids))
                    to = max(fit, at + 1)
                    group.add(doc_ids[at:to], sizes[at:to].tolist(), ids[ends[at] : ends[to]])
                    at = to
                    if len(group.sizes) >= GROUP_DOCUMENTS or group.tokens >= GROUP_TOKENS:
                        yield from flush()
        if group.sizes:
            yield from flush()

    return pack


def pack_documents(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
    special_as_text: bool = True,
) -> DataFrame:
    """Pieces of the documents' ids, each with its place in a sequence of at most ``length`` ids.

    Documents are dealt out by a hash of their id and packed in groups of bounded size in the order of another
    hash, so a group is a random sample whatever the input's order. ``ids`` holds a piece's ids unless
    ``with_ids`` is off. The strings of special tokens inside texts are ordinary text, or their ids if
    ``special_as_text`` is off. Null and empty texts are the end id alone; a null doc_id stays null; repeated rows are
    packed each; texts of any length are cut into pieces; other columns are ignored, whatever their names; an empty
    table gives no pieces. Sequences are full, or as long as a power of two.
    """
    order = F.xxhash64(F.lit(17), "doc_id")
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = named.repartition(task_count(docs.sparkSession), F.xxhash64("doc_id"))
    ordered = dealt.sortWithinPartitions(order, "doc_id", F.length("text"))
    return arrow_job(ordered, packer(path, length, end_id, with_ids, special_as_text), PIECES)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = END_ID) -> DataFrame:
    """``sequence_id, input_ids, segment_ids``: a row per sequence, padded unless its size is a power of two.

    At most ``length`` ids meet under one sequence.
    """
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = pieces.groupBy("sequence_id").agg(held.alias("held"))
    ids = F.flatten(F.transform("held", lambda p: p["ids"]))
    segment = F.flatten(F.transform("held", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"]))))
    size = F.size(ids)
    room = F.when(F.bit_count(size) == 1, 0).otherwise(length - size)
    return rows.select(
        "sequence_id",
        F.concat(ids, F.array_repeat(F.lit(pad_id), room)).alias("input_ids"),
        F.concat(segment, F.array_repeat(F.lit(0), room)).alias("segment_ids"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), tokenizer_path(), with_ids=False)
    return pieces.drop("ids")
