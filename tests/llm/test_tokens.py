"""Packing and token files against the tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA
from llm_tables import SCHEMA, awkward, sentence, write_tables
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from colonnade.llm import packing, token_files, tokens


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(tokens.tokenizer_path())
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = [
    "don't won't x's'ta 'll", "a  b   c\n\n d \t e", " lead and trail ", "l'eau d’été — “quoted”, (x)…", "<|endoftext|> is text",
    "1,234.5 6,7 abc123def ...!? $%&", "nbsp   x  y z", "emoji 👩‍👩‍👧 🇩🇪 and 漢字 かな العربية हिन्दी", "á ëx", "\r\n\r\n x\x0by", "''s ''s's",
]


def odd_texts():
    rng = random.Random(1)
    alphabet = [*"ab1 '  .,!\n\t é漢́sx×÷𝔘", "'s", " the", "…", *map(chr, (0x85, 0xA0, 0x2003, 0x3000, 0xFEFF)), "<|endoftext|>"]
    return [*ODD, "", None, *("".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(600))]


@pytest.mark.parametrize("special_as_text", [True, False])
def test_parts_have_the_ids_of_the_whole(special_as_text, monkeypatch):
    texts, plain = odd_texts(), Tokenizer.from_file(tokens.tokenizer_path())
    plain.encode_special_tokens = special_as_text
    for memo, at_once in ((0, 7), (5, 1000), (100_000, 500_000)):
        monkeypatch.setattr(tokens, "PARTS_AT_ONCE", at_once)
        encoder = tokens.byte_level(tokens.tokenizer_path(), special_as_text, memo)
        for column in (pa.array(texts), pa.array(["other", *texts])[1:]):
            ids, ends = encoder.encode(column)
            for i, text in enumerate(texts):
                assert ids[ends[i] : ends[i + 1]].tolist() == ids_of(plain, text)
        assert encoder.filled <= len(encoder.pool)
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 5, None, "", "y" * 30, "z", "z" * 4])], names=["t"])
    for most in (1, 6, 1000):
        slices = list(tokens.text_slices(batch, 0, most))
        assert sum((s.column(0).to_pylist() for s in slices), []) == batch.column(0).to_pylist()


def check_pieces(pieces, rows, tokenizer):
    wanted = sorted(([*ids_of(tokenizer, text), 0] for _, text in rows))
    by_doc = {}
    for r in pieces:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert sum(len(w) for w in wanted) == sum(r.length for r in pieces)
    seen = []
    for (doc_id, size), mine in by_doc.items():
        copies = {}
        for r in sorted(mine, key=lambda r: r.start):
            copies.setdefault(r.start, []).append(r)
        for text in {t for d, t in rows if d == doc_id}:
            ids = [*ids_of(tokenizer, text), 0]
            if len(ids) == size:
                seen.append(ids)
                for start, some in copies.items():
                    for r in some:
                        assert r.ids_crc32 == zlib.crc32(np.array(ids[start : start + r.length], "<u4").tobytes())
    held = {}
    for r in pieces:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 1024 or at & (at - 1) == 0
    return held


def test_packing_awkward_rows(spark, tmp_path, tokenizer):
    rows = awkward()
    got = packing.op3_packing(spark, write_tables(spark, tmp_path / "t", rows)).collect()
    check_pieces(got, [r[:2] for r in rows], tokenizer)


def test_sequences_hold_the_documents(spark, tokenizer):
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.randrange(400), 50)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS offset", "2 AS ids")
    pieces = packing.pack_documents(docs, tokens.tokenizer_path())
    check_pieces(pieces.collect(), rows, tokenizer)
    done = packing.sequences(pieces, pad_id=99).collect()
    sizes = [len(r.input_ids) for r in done]
    assert all(s == 1024 or s & (s - 1) == 0 for s in sizes) and all(len(r.segment_ids) == len(r.input_ids) for r in done)
    total = sum(len(ids_of(tokenizer, t)) + 1 for _, t in rows)
    assert sum(sizes) == total  # nothing is padded
    assert packing.pack_documents(docs.limit(0), tokens.tokenizer_path()).count() == 0


def test_special_tokens_by_parameter(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    packed = [packing.pack_documents(docs, tokens.tokenizer_path(), special_as_text=x) for x in (True, False)]
    ids = [sum((r.ids for r in p.orderBy("start").collect()), []) for p in packed]
    assert ids == [[64, 1279, 91, 437, 1659, 5239, 91, 29, 275, 0], [64, 220, 50256, 275, 0]]


def test_first_fit_by_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        sizes = [rng.randrange(1, 100) for _ in range(rng.randrange(1, 200))]
        tree, bins = packing.Tournament(100), []
        for size in sizes:
            at = next((k for k, room in enumerate(bins) if room >= size), len(bins))
            if at == len(bins):
                bins.append(100)
            bins[at] -= size
            assert tree.place(size) == at


def test_groups_cover_every_document_once():
    rng = random.Random(8)
    for _ in range(50):
        sizes = [rng.choice([1, 5, 1023, 1024, 1025, rng.randrange(1, 5000)]) for _ in range(rng.randrange(1, 60))]
        packed = packing.Group(sizes).pack(1024)
        seen = {}
        for pieces in packed:
            total = sum(size for _, _, size in pieces)
            assert total == 1024 or (total < 1024 and total & (total - 1) == 0)
            for number, start, size in pieces:
                seen.setdefault(number, []).append((start, size))
        for number, size in enumerate(sizes):
            at = 0
            for start, length in sorted(seen[number]):
                assert start == at
                at += length
            assert at == size


def test_elias_fano_round_trip():
    rng = np.random.default_rng(3)
    for values in ([0], [0, 0, 0], [0, 1, 2, 3], np.cumsum(rng.integers(0, 5000, 1000)), np.cumsum(rng.integers(0, 2, 500)), [0, 10**9]):
        values = np.array(values, np.int64)
        coded = token_files.EliasFano.encode(values)
        assert [coded.select(i) for i in range(len(values))] == values.tolist()
        for first, count in ((0, len(values)), (len(values) // 2, len(values) - len(values) // 2), (len(values) - 1, 1), (len(values) // 3, 1)):
            assert coded.select_run(first, count).tolist() == values[first : first + count].tolist()
    values = np.cumsum(rng.integers(0, 5000, 10_000))
    coded = token_files.EliasFano.encode(values)
    bits = 8 * (len(coded.upper) + len(coded.lower)) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1


def test_a_file_is_read_as_written():
    file = token_files.TokenFile.of([3, None, 9], [np.array(x, "<u2") for x in ([5, 2], [2], [7, 8, 2])])
    back = token_files.TokenFile.load(file.dump())
    assert back.doc_ids.tolist() == [3, 0, 9] and back.nulls.tolist() == [0, 1, 0]
    assert [back.document(i).tolist() for i in range(3)] == [[5, 2], [2], [7, 8, 2]]
    with pytest.raises(ValueError):
        token_files.TokenFile.load(b"something else entirely")


def test_files_in_id_order(spark, tmp_path, tokenizer):
    rows = awkward()
    got = token_files.op7_token_files(spark, write_tables(spark, tmp_path / "t", rows)).collect()
    at = 0
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    sums = {}
    for doc_id, text, *_ in rows:
        ids = np.array([*ids_of(tokenizer, text), 2], "<u4")
        sums.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in ordered:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in sums[r.doc_id]
        at += r.n_tokens


def test_small_files_and_their_ids(spark, tmp_path, tokenizer):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").withColumn("start", F.lit("x"))
    folder = str(tmp_path / "files")
    files = token_files.write_token_files(docs, folder, tokens.tokenizer_path(), file_ids=5000)
    assert files.count() > 5 and files.agg(F.sum("n_docs")).first()[0] == docs.count()
    got = {r.doc_id: r.ids for r in token_files.read_token_files(files, folder).collect()}
    for r in docs.limit(20).collect():
        assert got[r.doc_id] == [*ids_of(tokenizer, r.text), 2]


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    assert token_files.op7_token_files(spark, folder).count() == 0
    assert packing.op3_packing(spark, folder).count() == 0
