"""Token ids of whole texts: cut where the tokenizer cuts anyway, then each distinct part is encoded once.

Texts come as Arrow strings and are cut on their UTF-8 bytes with numpy; the parts are slices of the same buffer.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_PARTS = 300_000
PARTS_AT_ONCE = 500_000
SLICE_BYTES = 4_000_000


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in these ranges, both ends included."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


WHITE = _bytes((0x09, 0x0D), (0x20, 0x20))
VISIBLE = _bytes((0x21, 0x7E))
LETTERS = _bytes((0x41, 0x5A), (0x61, 0x7A))
MARKS = _bytes((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
# First bytes of characters of two, three and four bytes among which there is no white space.
LEAD2, LEAD3, LEAD4 = _bytes((0xC3, 0xDF)), _bytes((0xE4, 0xED)), _bytes((0xF0, 0xF4))


def byte_level_cuts(data: np.ndarray) -> np.ndarray:
    """Where byte-level BPE with the usual pattern always begins a new word.

    White space always begins one after a visible character, and so does a mark after a letter. After characters
    that might be white space, or marks, nothing is cut. A text cut there has the same ids, part by part, as the whole.
    """
    seen, letter = VISIBLE[data], LETTERS[data]
    for table, width in ((LEAD2, 2), (LEAD3, 3), (LEAD4, 4)):
        seen[width - 1 :] |= table[data[: len(data) - width + 1]]
    cuts = np.zeros(len(data), bool)
    cuts[1:] = (WHITE[data[1:]] & seen[:-1]) | (MARKS[data[1:]] & letter[:-1])
    return cuts


def blank_cuts(data: np.ndarray) -> np.ndarray:
    """Before each blank that no blank precedes: right for pieces that hold blanks in front only."""
    cuts = np.zeros(len(data), bool)
    cuts[1:] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    return cuts


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def text_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with some ``most`` bytes of text each, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(edges, edges[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


class Encoder:
    """Encodes columns of texts. Ids of parts seen before come from a memo of bounded size.

    ``ids_of`` encodes a list of parts, ``cuts`` marks the bytes at which parts begin, and texts that hold one of the
    strings ``whole`` are not cut.
    """

    def __init__(
        self,
        ids_of: Callable[[list[str]], list[list[int]]],
        cuts: Callable[[np.ndarray], np.ndarray],
        size: int,
        memo_parts: int = MEMO_PARTS,
        whole: tuple[str, ...] = (),
    ):
        self.ids_of, self.cuts, self.memo_parts, self.whole = ids_of, cuts, memo_parts, whole
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.place: dict[str, int] = {}
        self.begin = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 20, self.dtype)
        self.filled = 0

    def _learn(self, missing: list[str]) -> None:
        for at in range(0, len(missing), 4096):
            names = missing[at : at + 4096]
            ids = self.ids_of(names)
            sizes = np.array([len(x) for x in ids], np.int32)
            first, total = len(self.place), int(sizes.sum())
            while first + len(names) > len(self.begin):
                self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
            while self.filled + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.filled : self.filled + total] = np.fromiter((i for x in ids for i in x), self.dtype, total)
            self.begin[first : first + len(names)] = self.filled + np.cumsum(sizes) - sizes
            self.length[first : first + len(names)] = sizes
            self.place.update(zip(names, range(first, first + len(names)), strict=True))
            self.filled += total

    def _parts(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' bytes end to end, where parts begin (one more entry for the end), each row's first part."""
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        mark = self.cuts(data)
        for string in self.whole:
            for row in np.flatnonzero(pc.match_substring(texts, string).to_numpy(zero_copy_only=False)):
                mark[ends[row] : ends[row + 1]] = False
        mark[ends[ends < len(data)]] = True
        begins = np.append(np.flatnonzero(mark), len(data)).astype(np.int32)
        return data, begins, np.searchsorted(begins, ends)

    def encode(self, column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows end to end, and where each row's ids begin (one more entry for the end)."""
        texts = pc.fill_null(column, "") if column.null_count else column
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        data, begins, first = self._parts(texts)
        found, counts = [np.zeros(0, self.dtype)], [np.zeros(1, np.int64)]
        for at in range(0, len(begins) - 1, PARTS_AT_ONCE):
            edges = begins[at : at + PARTS_AT_ONCE + 1]
            ids, sizes = self._some(data, edges)
            found.append(ids)
            counts.append(sizes)
        return np.concatenate(found), np.cumsum(np.concatenate(counts))[first]

    def _some(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some parts end to end, and how many each has."""
        full, filled = len(self.place) >= self.memo_parts, self.filled
        buffers = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.StringArray.from_buffers(len(edges) - 1, *buffers[1:]).dictionary_encode()
        names = coded.dictionary.to_pylist()
        missing = [name for name in names if name not in self.place]
        self._learn(missing)
        places = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        at = places[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.length[at].astype(np.int64)
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.begin[at] - (ends - sizes), sizes) + np.arange(ends[-1])]
        if full:  # the first parts stay, and those are mostly the frequent ones
            for name in missing:
                del self.place[name]
            self.filled = filled
        return ids, sizes


def byte_level(path: str, special_as_text: bool = True, memo_parts: int = MEMO_PARTS) -> Encoder:
    """An encoder for a byte-level BPE file of the tokenizers library.

    ``special_as_text`` says whether the strings of special tokens inside texts are ordinary text (so no text can write a
    special id) or become their ids, as the library has it unless told otherwise.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    added = tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())

    def ids_of(names: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(names, add_special_tokens=False)]

    whole = () if special_as_text else added
    return Encoder(ids_of, byte_level_cuts, tokenizer.get_vocab_size(), memo_parts, whole)


@lru_cache(maxsize=2)
def encoder(path: str, special_as_text: bool = True) -> Encoder:
    """One encoder for each worker process, kept between tasks."""
    return byte_level(path, special_as_text)
