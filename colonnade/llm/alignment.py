"""Operator 12: alignment of two tokenizers' tokens of the same text, by merge paths.

The ends of A's and of B's tokens are two rising lists of byte offsets. Their merge is cut by binary searches along
diagonals into pieces of equal work, however long a text is; each piece finds the overlaps and groups among its own ends
without knowing the others. Groups that lie over a cut are put together at the end, piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_environment, arrow_job, documents, stored
from colonnade.llm.tokens import Encoder, blank_cuts, byte_level, text_slices, tokenizer_path

WORK = 1 << 16  # ends of A and B in one piece
BLOCK_WORK = 4_000_000  # ends in a block of pieces whose id pairs are looked up together
MERGE_WORK = 500_000  # ends merged at once
BLANK = "▁"  # stands for a blank in pieces


class Vocabulary:
    """An encoder and the bytes of each of its tokens. ``faithful``: tokens always spell the text."""

    def __init__(self, encoder: Encoder | None, tokens: list[bytes], faithful: bool = False):
        self.encoder, self.faithful = encoder, faithful
        self.dtype = np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The tokens' bytes end to end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.begins[ids] - (ends - sizes), sizes) + np.arange(total)]


def byte_level_bytes() -> dict[str, int]:
    """The characters that byte-level BPE writes for bytes: visible ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(BLANK, " ").encode()


@lru_cache(maxsize=2)
def vocabulary_a(path: str) -> Vocabulary:
    from tokenizers import Tokenizer

    tokenizer, of = Tokenizer.from_file(path), byte_level_bytes()
    names = (tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size()))
    tokens = [bytes(of[c] for c in name if c in of) for name in names]
    # With a token for every byte and nothing that changes texts before, byte-level BPE can't lose a byte.
    faithful = tokenizer.normalizer is None and {bytes([b]) for b in range(256)} <= set(tokens)
    return Vocabulary(byte_level(path), tokens, faithful)


@lru_cache(maxsize=2)
def vocabulary_b(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    blank = model.piece_to_id(BLANK)
    # Where no piece holds a blank behind something else, nothing is merged over such a place and texts can be cut there.
    local = not any(BLANK in piece.lstrip(BLANK) for piece in pieces)

    def ids_of(names: list[str]) -> list[list[int]]:
        found = model.encode([name[1:] for name in names], num_threads=1)  # the model adds the first blank
        return [[blank] if name == " " else ids for name, ids in zip(names, found, strict=True)]  # but not to nothing

    cuts = blank_cuts if local else lambda data: np.zeros(len(data), bool)
    return Vocabulary(Encoder(ids_of, cuts, len(pieces)), [piece_bytes(piece) for piece in pieces])


def split_at(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many of the first ``diagonal`` ends of the merge are A's and B's; equal ends are never parted."""
    low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[diagonal - 1 - middle]:
            low = middle + 1
        else:
            high = middle
    i, j = low, diagonal - low
    return i, j + 1 if i and j < len(b) and a[i - 1] == b[j] else j


PIECES = (
    "block bigint, row bigint, doc_id bigint, piece int, n_pieces int, n_a bigint, n_b bigint, a_begin bigint, "
    "b_begin bigint, a_ids binary, b_ids binary"
)


def names_of(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def cutter(path_a: str, path_b: str, work: int, block_work: int) -> Callable:
    """The Arrow task that encodes texts and cuts each merge into pieces.

    A piece holds its own tokens and of each side the token after them, in which its last bytes may lie.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = vocabulary_a(path_a), vocabulary_b(path_b)
        pack = zstandard.ZstdCompressor(level=1).compress
        row = block = TaskContext.get().partitionId() << 40
        filled = 0

        def of_row(doc_id, ids_a: np.ndarray, ids_b: np.ndarray) -> Iterator[tuple]:
            ends_a, ends_b = np.cumsum(a.sizes[ids_a]), np.cumsum(b.sizes[ids_b])
            total = len(ids_a) + len(ids_b)
            splits = [(0, 0), *(split_at(ends_a, ends_b, d) for d in range(work, total, work)), (len(ids_a), len(ids_b))]
            for piece, ((i, j), (k, m)) in enumerate(zip(splits, splits[1:], strict=False)):
                begins = (int(ends_a[i - 1]) if i else 0, int(ends_b[j - 1]) if j else 0)
                held = (pack(ids_a[i : k + 1].astype(a.dtype).tobytes()), pack(ids_b[j : m + 1].astype(b.dtype).tobytes()))
                yield (row, doc_id, piece, len(splits) - 1, k - i, m - j, *begins, *held)

        for batch in batches:
            for some in text_slices(batch, 1):
                texts = some.column(1)
                (ids_a, at_a), (ids_b, at_b) = a.encoder.encode(texts), b.encoder.encode(texts)
                good = equal_bytes(texts, a, ids_a, at_a) & equal_bytes(texts, b, ids_b, at_b)
                out: list[tuple] = []
                for k, doc_id in enumerate(some.column(0).to_pylist()):
                    mine = [x[at[k] : at[k + 1]] if good[k] else x[:0] for x, at in ((ids_a, at_a), (ids_b, at_b))]
                    for piece in of_row(doc_id, *mine):
                        if filled >= block_work:
                            block, filled = block + 1, 0
                        out.append((block, *piece))
                        filled += piece[4] + piece[5]
                    row += 1
                kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 4 + [pa.binary()] * 2
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names_of(PIECES))

    return cut


def equal_bytes(texts: pa.StringArray, side: Vocabulary, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text whether its tokens' bytes are its own."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(side.sizes[ids]))[at]
    good = np.diff(ends) == sizes
    if side.faithful:
        return good
    kept = np.repeat(good, np.diff(at))
    chosen = texts.filter(pa.array(good))
    _, offsets, data = chosen.buffers()
    bounds = np.frombuffer(offsets, np.int32)[chosen.offset : chosen.offset + len(chosen) + 1]
    if not len(chosen) or bounds[0] == bounds[-1]:
        return good
    differ = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] != side.joined(ids[kept])
    rows = np.searchsorted(bounds - bounds[0], np.flatnonzero(differ), "right") - 1
    good[np.flatnonzero(good)[rows]] = False
    return good


class Merge:
    """The merged ends of some pieces, laid out one behind the other on one scale of bytes.

    ``piece``, ``a``, ``b`` name each link: the piece it was found in and the places of its two tokens. A link is the
    stretch up to an end and from the end before; its tokens are those the stretch lies in. Ends are marked on the scale,
    so that merging, and finding the token around an end, are running sums.
    """

    def __init__(self, pieces: pa.Table | pa.RecordBatch, a: Vocabulary, b: Vocabulary):
        unpack = zstandard.ZstdDecompressor().decompress
        own = [pieces.column(name).to_numpy() for name in ("n_a", "n_b")]
        begins = [pieces.column(name).to_numpy() for name in ("a_begin", "b_begin")]
        start = np.minimum(*begins)
        self.ids, ends, span = [], [], np.zeros(pieces.num_rows, np.int64)
        for name, side, begin in zip(("a_ids", "b_ids"), (a, b), begins, strict=True):
            held = [np.frombuffer(unpack(x), side.dtype) for x in pieces.column(name).to_pylist()]
            counts = np.array([len(x) for x in held], np.int64)
            ids = np.concatenate(held).astype(np.int64) if held else np.zeros(0, np.int64)
            total = np.append(0, np.cumsum(side.sizes[ids]))
            first = np.cumsum(counts) - counts
            local = total[1:] - np.repeat(total[first] - begin + start, counts)
            span = np.maximum(span, total[first + counts] - total[first] + begin - start)
            self.ids.append(ids)
            ends.append((local, counts, first))
        base = np.cumsum(span + 1) - span - 1
        self.edges = np.append(base, base[-1] + span[-1] + 1) if len(base) else np.zeros(1, np.int64)
        # A piece's own tokens, without those that follow.
        mine = [np.arange(len(x)) - np.repeat(first, n) < np.repeat(o, n) for (x, n, first), o in zip(ends, own, strict=True)]
        all_ends = [local + np.repeat(base, counts) for local, counts, _ in ends]
        self.mine = [np.flatnonzero(m) for m in mine]
        self.ends = [end[m] for end, m in zip(all_ends, self.mine, strict=True)]
        marks = [self._marks(x) for x in self.ends]
        self.common = np.flatnonzero(marks[0] & marks[1])
        self.links = np.flatnonzero(marks[0] | marks[1])
        self.a, self.b = (self._before(self._marks(x), self.links) for x in all_ends)
        self.piece = np.repeat(np.arange(pieces.num_rows), self.per_piece(self.links))

    def _marks(self, places: np.ndarray) -> np.ndarray:
        marks = np.zeros(self.edges[-1] + 1, bool)
        marks[places] = True
        return marks

    @staticmethod
    def _before(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How many marks lie before each place; none is at the scale's beginning."""
        return np.cumsum(marks, dtype=np.int32)[places - 1]

    def pairs(self) -> np.ndarray:
        return self.ids[0][self.a] << 32 | self.ids[1][self.b]

    def per_piece(self, places: np.ndarray) -> np.ndarray:
        """How many of the rising places lie in each piece."""
        return np.diff(np.searchsorted(places, self.edges, "right"))

    def group_keys(self) -> tuple[list[np.ndarray], np.ndarray]:
        """For each side its own tokens' groups, and each piece's first; its last, after all common ends, may be empty."""
        marks = self._marks(self.common)
        marks[self.edges[1:]] = True
        first = np.append(0, np.cumsum(self.per_piece(self.common) + 1))
        return [self._before(marks, end) for end in self.ends], first


def slices_of(pieces: pa.Table | pa.RecordBatch, most: int) -> Iterator[pa.Table | pa.RecordBatch]:
    run = np.cumsum(pieces.column("n_a").to_numpy() + pieces.column("n_b").to_numpy()) // most
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), pieces.num_rows]
    for begin, end in zip(edges, edges[1:], strict=False):
        if end > begin:
            yield pieces.slice(begin, end - begin)


PAIRS = "block bigint, pair bigint, n bigint"


def pair_counter(path_a: str, path_b: str) -> Callable:
    """The Arrow task that counts the linked id pairs of each block of pieces; blocks follow each other."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = vocabulary_a(path_a), vocabulary_b(path_b)
        block, pairs, counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def told() -> pa.RecordBatch:
            arrays = [pa.array(np.full(len(pairs), block, np.int64)), pa.array(pairs), pa.array(counts)]
            return pa.RecordBatch.from_arrays(arrays, names=names_of(PAIRS))

        for batch in batches:
            for some in slices_of(batch, MERGE_WORK):
                merge = Merge(some, *sides)
                found, owner = merge.pairs(), some.column("block").to_numpy()
                for one in np.unique(owner):
                    if one != block:
                        if len(pairs):
                            yield told()
                        block, pairs, counts = int(one), pairs[:0], counts[:0]
                    here = found if (owner == one).all() else found[(owner == one)[merge.piece]]
                    new = pa.array(here).value_counts()
                    every = np.concatenate([pairs, new.field(0).to_numpy()])
                    pairs, place = np.unique(every, return_inverse=True)
                    counts = np.bincount(place, np.concatenate([counts, new.field(1).to_numpy()]), len(pairs)).astype(np.int64)
        if len(pairs):
            yield told()

    return count


@lru_cache(maxsize=1)
def written_ids(size: int) -> list[str]:
    """Decimal ids with each of the marks that can follow: comma, bar, semicolon."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(size)]


MERGED = (
    "row bigint, doc_id bigint, piece int, n_pieces int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "n_best bigint, count_sum bigint, groups_sha256 string, head_a string, head_b string, body string, tail_a string, "
    "tail_b string"
)


def scorer(path_a: str, path_b: str) -> Callable:
    """The cogrouped task: a block's pieces and, of every id pair in it, the count and whether it is its B id's highest."""

    def score(pieces: pa.Table, known: pa.Table) -> pa.Table:
        sides = vocabulary_a(path_a), vocabulary_b(path_b)
        most_ids = max(len(side.sizes) for side in sides)
        pair = known.column("pair").combine_chunks()
        n, best = known.column("n").to_numpy(), known.column("best").to_numpy().astype(np.int64)
        out = []
        for some in slices_of(pieces, MERGE_WORK):
            merge = Merge(some, *sides)
            links = merge.per_piece(merge.links)
            found = pc.index_in(pa.array(merge.pairs()), value_set=pair).to_numpy(zero_copy_only=False)
            begin = np.append(0, np.cumsum(links))
            n_best, count_sum = (np.diff(np.append(0, np.cumsum(x[found]))[begin]) for x in (best, n))
            numbers = (merge.per_piece(merge.common), links, n_best, count_sum)
            texts = _texts(some, merge, most_ids)
            copied = [some.column(name) for name in ("row", "doc_id", "piece", "n_pieces", "n_a", "n_b")]
            arrays = [*copied, *(pa.array(x.astype(np.int64)) for x in numbers), *(pa.array(x, pa.string()) for x in texts)]
            out.append(pa.table(dict(zip(names_of(MERGED), arrays, strict=True))))
        return pa.concat_tables(out) if out else pa.table({k: pa.array([], t) for k, t in MERGED_TYPES})

    return score


MERGED_TYPES = [
    (name, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[field.split()[1]])
    for name, field in zip(names_of(MERGED), MERGED.split(", "), strict=True)
]


def _texts(some: pa.Table, merge: Merge, size: int) -> list[list[str | None]]:
    """Digest of whole documents' groups; of other pieces what stitching needs: head, body and tail."""
    keys, first = merge.group_keys()
    counts = [np.bincount(key, minlength=first[-1]) for key in keys]
    n_a, begins = counts[0].tolist(), np.append(0, np.cumsum(counts[0] + counts[1]))
    text = np.zeros(begins[-1], np.int64)
    for side, (key, n, last) in enumerate(zip(keys, counts, (1, 2), strict=True)):
        ids = merge.ids[side][merge.mine[side]]
        place = np.arange(len(ids)) + (begins[:-1] - (np.cumsum(n) - n) + (counts[0] if side else 0))[key]
        ends = np.append(key[1:] != key[:-1], True)[: len(key)]
        text[place] = ids + size * last * ends
    words = list(map(written_ids(size).__getitem__, text.tolist()))
    begins, first = begins.tolist(), first.tolist()
    whole, closed = (some.column("n_pieces").to_numpy() == 1).tolist(), merge.per_piece(merge.common).tolist()
    columns: list[list[str | None]] = [[] for _ in range(6)]

    def open_group(x: int) -> tuple[str, str]:
        """A group that may go on in another piece: the ids of each side, a comma after each."""
        parts = words[begins[x] : begins[x] + n_a[x]], words[begins[x] + n_a[x] : begins[x + 1]]
        return tuple("".join(part).replace("|", ",").replace(";", ",") for part in parts)

    for k in range(some.num_rows):
        g, h = first[k], first[k + 1]
        if whole[k]:
            text = "".join(words[begins[g] : begins[h]])[:-1]
            told = (hashlib.sha256(text.encode()).hexdigest() if text else "", None, None, None, None, None)
        else:
            last = g + closed[k]  # the group that is not closed
            body = "".join(words[begins[g + 1] : begins[last]]) if closed[k] else None
            told = (None, *open_group(g), body, *(open_group(last) if closed[k] else ("", "")))
        for column, value in zip(columns, told, strict=True):
            column.append(value)
    return columns


def stitch(pieces: pa.Table) -> pa.Table:
    """A document's row from its pieces: sums, and the digest of all groups with those over the cuts put together.

    A piece without a common end (null body) lies inside one group. The pieces hold one document's tokens.
    """
    rows = sorted(pieces.to_pylist(), key=lambda r: r["piece"])
    digest, between = hashlib.sha256(), ""
    open_a, open_b = [], []
    for r in rows:
        open_a.append(r["head_a"])
        open_b.append(r["head_b"])
        if r["body"] is not None:
            digest.update(f"{between}{''.join(open_a)[:-1]}|{''.join(open_b)[:-1]}".encode())
            if r["body"]:
                digest.update(f";{r['body'][:-1]}".encode())
            open_a, open_b, between = [r["tail_a"]], [r["tail_b"]], ";"
    out = {"doc_id": [rows[0]["doc_id"]]}
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        out[name] = [sum(r[name] for r in rows)]
    arrays = {name: pa.array(values, pa.int64()) for name, values in out.items()}
    return pa.table(arrays | {"groups_sha256": pa.array([digest.hexdigest()])})


ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)


def cut_pieces(docs: DataFrame, path_a: str, path_b: str, work: int = WORK, block_work: int = BLOCK_WORK) -> DataFrame:
    """The token pieces (``PIECES``) of every row, written and read again; small row groups, so long texts spread."""
    text = F.when(F.length("text") > 0, F.concat(F.lit(" "), "text")).otherwise("")
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    options = {"parquet.block.size": str(8 << 20)}
    return stored(docs.sparkSession, arrow_job(named, cutter(path_a, path_b, work, block_work), PIECES), "pieces", options)


def pair_counts(pieces: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """The id pairs of each block, and corpus-wide ``pair, n, best``: links that hold a pair, and if none of its B id has more.

    A pair is A's id in the upper and B's in the lower 32 bits.
    """
    spark = pieces.sparkSession
    blocks = stored(spark, arrow_job(pieces, pair_counter(path_a, path_b), PAIRS), "block-pairs")
    counts = stored(spark, blocks.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # At most a row for each id of B, whatever the corpus.
    top = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    known = counts.withColumn("b_id", b_id).join(F.broadcast(top), "b_id")
    return blocks, known.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, path_a: str, path_b: str, work: int = WORK, block_work: int = BLOCK_WORK
) -> DataFrame:
    """Per row of ``docs`` the figures of ``ALIGNED``: how the tokens of A and B overlap.

    Null and empty texts, and those whose tokens do not spell blank and text, have no tokens: zeros and ''. Texts of any
    length are cut into pieces of at most ``work`` ends. Repeated rows count and are returned each, a null doc_id stays
    null, other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = cut_pieces(docs, path_a, path_b, work, block_work)
    blocks, known = pair_counts(pieces, path_a, path_b)
    needed = blocks.select("block", "pair").distinct().join(known, "pair").select("block", "pair", "n", "best")
    arrow_environment(spark)
    met = pieces.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(scorer(path_a, path_b), MERGED)
    merged = stored(spark, met, "merged")
    names = names_of(ALIGNED)
    single = merged.filter("n_pieces = 1").select(*names)
    several = merged.filter("n_pieces > 1").groupBy("row").applyInArrow(stitch, ALIGNED)
    return single.unionByName(several)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
