"""Operator 7: token-id files. Ids end to end, with Elias-Fano coded document boundaries.

A file: the magic bytes, five little-endian 64-bit numbers (documents, ids, bytes per id, low bits, bytes of the upper
part), the doc_ids (64 bits each, then a byte each that is 1 for null), the upper and lower bits of the boundaries, the
select samples, the ids. A boundary v with number i sets bit ``(v >> low) + i`` of the upper part and keeps its ``low``
last bits in the lower part: about two bits and ``low`` bits a document, whatever the size of the file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_job, documents, stored, task_count
from colonnade.llm.tokens import encoder, text_slices, tokenizer_path
from colonnade.session import scratch_dir

MAGIC = b"COLTOK01"
END_ID = 2
SAMPLE = 64  # every how many boundaries the place of the set bit is noted
FILE_IDS = 8_000_000  # a file ends with the document that reaches this


class EliasFano:
    """A rising sequence of numbers in near-minimal space, with access to each by its number."""

    def __init__(self, count: int, low: int, upper: np.ndarray, lower: np.ndarray, samples: np.ndarray):
        self.count, self.low, self.upper, self.lower, self.samples = count, low, upper, lower, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        count, last = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (last // max(count, 1)).bit_length() - 1)
        ones = (values >> low) + np.arange(count)
        bits = np.zeros((last >> low) + count + 1, np.uint8)
        bits[ones] = 1
        tail = (values[:, None] >> np.arange(low)) & 1
        return cls(
            count, low, np.packbits(bits, bitorder="little"),
            np.packbits(tail.astype(np.uint8).reshape(-1), bitorder="little"), ones[::SAMPLE].astype("<u4"),
        )

    @staticmethod
    def lower_bytes(count: int, low: int) -> int:
        return (count * low + 7) // 8

    def _low_bits(self, first: int, count: int) -> np.ndarray:
        begin, end = first * self.low, (first + count) * self.low
        bits = np.unpackbits(self.lower[begin // 8 : (end + 7) // 8], bitorder="little")
        bits = bits[begin % 8 : begin % 8 + count * self.low].reshape(count, self.low)
        return bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))

    def select(self, number: int) -> int:
        """The value with this number: the nearest sample, then set bits counted byte by byte."""
        at = int(self.samples[number // SAMPLE])
        left = number % SAMPLE
        byte = at // 8
        bits = np.unpackbits(self.upper[byte : byte + 1], bitorder="little")
        bits[: at % 8] = 0
        while (found := int(bits.sum())) <= left:
            left -= found
            byte += 1
            bits = np.unpackbits(self.upper[byte : byte + 1], bitorder="little")
        place = 8 * byte + int(np.flatnonzero(bits)[left])
        return ((place - number) << self.low) | int(self._low_bits(number, 1)[0])

    def select_run(self, first: int, count: int) -> np.ndarray:
        """The values numbered ``first`` to ``first + count - 1``: walks on from the sample before the first.

        Only the bits between two samples are unpacked, never the whole upper part.
        """
        last = first + count
        begin = int(self.samples[first // SAMPLE])
        after = -(-last // SAMPLE)
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.upper)
        bits = np.unpackbits(self.upper[begin // 8 : end // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits[begin % 8 :])[first % SAMPLE : first % SAMPLE + count] + begin
        return ((ones - np.arange(first, last)) << self.low) | self._low_bits(first, count)


class TokenFile:
    """A file's content, read or to be written."""

    def __init__(self, doc_ids: np.ndarray, nulls: np.ndarray, bounds: EliasFano, ids: np.ndarray):
        self.doc_ids, self.nulls, self.bounds, self.ids = doc_ids, nulls, bounds, ids

    @classmethod
    def of(cls, doc_ids: list[int | None], pieces: list[np.ndarray]) -> TokenFile:
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        nulls = np.array([d is None for d in doc_ids], np.uint8)
        known = np.array([0 if d is None else d for d in doc_ids], "<i8")
        return cls(known, nulls, EliasFano.encode(bounds), np.concatenate(pieces))

    def dump(self) -> bytes:
        ef, ids = self.bounds, self.ids
        head = struct.pack("<5q", len(self.doc_ids), len(ids), ids.itemsize, ef.low, len(ef.upper))
        arrays = (self.doc_ids, self.nulls, ef.upper, ef.lower, ef.samples, ids)
        return MAGIC + head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def load(cls, data: bytes | memoryview) -> TokenFile:
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        count, total, width, low, upper = struct.unpack_from("<5q", data, 8)
        at = 48

        def take(kind: str, size: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, size, at)
            at += found.nbytes
            return found

        doc_ids, nulls = take("<i8", count), take("u1", count)
        upper_bits, lower = take("u1", upper), take("u1", EliasFano.lower_bytes(count + 1, low))
        samples = take("<u4", count // SAMPLE + 1)
        bounds = EliasFano(count + 1, low, upper_bits, lower, samples)
        return cls(doc_ids, nulls, bounds, take(f"<u{width}", total))

    def document(self, number: int) -> np.ndarray:
        return self.ids[self.bounds.select(number) : self.bounds.select(number + 1)]


FILES = "shard int, part int, file string, n_docs bigint, n_tokens bigint"


def writer(path: str, end_id: int, folder: str, file_ids: int, special_as_text: bool) -> Callable:
    """The Arrow task that writes a partition's documents, in order, to files of bounded size.

    A name is never used twice: a task that is run again writes new files, and only the rows Spark commits say
    which files count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        encode, shard, number = encoder(path, special_as_text), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        pieces: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, pieces, held, number
            name = f"{shard:06d}-{number:06d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(TokenFile.of(doc_ids, pieces).dump())
            row = [[shard], [number], [name], [len(doc_ids)], [held]]
            doc_ids, pieces, held, number = [], [], 0, number + 1
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "part", "file", "n_docs", "n_tokens"])

        store.create_dir(root, recursive=True)
        for batch in batches:
            for some in text_slices(batch, 1):
                ids, ends = encode.encode(some.column(1))
                ids = np.insert(ids, ends[1:], end_id)
                ends = (ends + np.arange(len(ends))).tolist()
                for k, doc_id in enumerate(some.column(0).to_pylist()):
                    doc_ids.append(doc_id)
                    pieces.append(ids[ends[k] : ends[k + 1]])
                    held += len(pieces[-1])
                    if held >= file_ids:
                        yield flush()
        if doc_ids:
            yield flush()

    return write


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    special_as_text: bool = True,
) -> DataFrame:
    """Write the ids of ``docs`` in ascending doc_id order; returns the files: ``FILES`` and ``start``.

    ``start`` counts the ids in the files before. The strings of special tokens inside texts are ordinary text, or their
    ids if ``special_as_text`` is off. Null ids come first, rows of one id in the order of a hash of their texts; null and
    empty texts are the end id alone; a text longer than ``file_ids`` fills a file of its own; other columns are ignored,
    whatever their names; an empty table writes no file. ``folder`` is a path or URI that executors share and pyarrow's
    file systems can open.
    """
    spark = docs.sparkSession
    tie = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(task_count(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie)
    texts = ordered.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    task = writer(path, end_id, folder, file_ids, special_as_text)
    files = stored(spark, arrow_job(texts, task, FILES), "token-files")
    # A row per task: as many as the session has shuffle partitions, however long the table.
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    sums = accumulate((r.n for r in shards), initial=0)
    before = [(r.shard, at) for r, at in zip(shards, sums, strict=False)]
    before = spark.createDataFrame(before, "shard int, before bigint")
    within = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("within", F.coalesce(within, F.lit(0))).join(F.broadcast(before), "shard")
    return placed.select(*files.columns, (F.col("before") + F.col("within")).alias("start"))


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"


def reader(folder: str, with_ids: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as source:
                    file = TokenFile.load(memoryview(source.read_buffer()))
                for begin in range(0, len(file.doc_ids), 2000):
                    end = min(begin + 2000, len(file.doc_ids))
                    bounds = file.bounds.select_run(begin, end - begin + 1)
                    pieces = [file.ids[b:e] for b, e in zip(bounds, bounds[1:], strict=False)]
                    ids = [p.astype(np.int32) if with_ids else None for p in pieces]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[begin:end], pa.int64(), mask=file.nulls[begin:end].astype(bool)),
                            pa.array(first + bounds[:-1], pa.int64()),
                            pa.array(np.diff(bounds), pa.int64()),
                            pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64()),
                            pa.array(ids, pa.list_(pa.int32())),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                    )

    return read


def read_token_files(files: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """A row per document of the files that ``write_token_files`` has listed."""
    listed = files.select("file", "start")
    spread = listed.repartition(task_count(files.sparkSession), "file")
    return arrow_job(spread, reader(folder, with_ids), READ)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "tokens")
    files = write_token_files(documents(spark, sf_dir), folder, tokenizer_path())
    return read_token_files(files, folder, with_ids=False).drop("ids")
