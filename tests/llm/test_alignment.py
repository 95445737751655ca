"""Token alignment against a plain version of its contract."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA
from llm_tables import SCHEMA, awkward, write_tables
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from colonnade.llm import alignment
from colonnade.llm.tokens import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
NAMES = alignment.names_of(alignment.ALIGNED)


def plain(rows):
    """The contract, token by token."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=B)
    of = alignment.byte_level_bytes()
    held, counts = [], Counter()
    for doc_id, text in rows:
        sides = []
        if text:
            a = [(i, bytes(of[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, alignment.piece_bytes(second.id_to_piece(i))) for i in second.encode(text)]
            if all(b"".join(x for _, x in side) == (" " + text).encode() for side in (a, b)):
                sides = [a, b]
        spans = []
        for side in sides:
            at, found = 0, []
            for i, data in side:
                found.append((i, at, at + len(data)))
                at += len(data)
            spans.append(found)
        links, groups = [], []
        if spans:
            cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
            left = [list(reversed(side)) for side in spans]
            for cut in cuts:
                sides = [[], []]
                for ids, side in zip(sides, left, strict=True):
                    while side and side[-1][2] <= cut:
                        ids.append(side.pop()[0])
                groups.append("|".join(",".join(map(str, ids)) for ids in sides))
            j = 0
            for i, s, e in spans[0]:
                while spans[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][1] < e:
                    links.append((i, spans[1][k][0]))
                    k += 1
        counts.update(links)
        held.append((doc_id, spans, groups, links))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for doc_id, spans, groups, links in held:
        n_a, n_b = (len(spans[0]), len(spans[1])) if spans else (0, 0)
        best = sum(counts[x] == highest[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.select(*NAMES).collect()), key=repr)


def odd_rows():
    rng = random.Random(3)
    alphabet = ["a", "b ", " ", "  ", "\n", "\t", "é", "漢", "👩", "the", " tion", "'s", "1", "<s>", "<0x0A>", "<|endoftext|>", "\r", "\x00"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))) for i in range(120)]
    return rows + [(500, "holds ▁ itself"), (501, "▁"), (502, "x▁ y"), (503, "  "), (504, "<unk>"), (505, "x" * 3000), (506, "　\xa0")]


def test_diagonals_split_the_merge():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(1, 40))) for _ in range(2))
        for d in range(len(a) + len(b) + 1):
            i, j = alignment.split_at(a, b, d)
            assert i + j in (d, d + 1)
            taken, left = [*a[:i], *b[:j]], [*a[i:], *b[j:]]
            assert not taken or not left or max(taken) < min(left)


@pytest.mark.parametrize(("work", "block_work"), [(1, 700), (3, 4000), (50, 10**6), (10**6, 10**6)])
def test_pieces_make_the_whole(spark, work, block_work):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(alignment.align(docs, A, B, work, block_work)) == plain(rows)


def test_awkward_rows(spark, tmp_path):
    rows = awkward()
    got = alignment.op12_token_alignment(spark, write_tables(spark, tmp_path / "t", rows))
    assert got.columns == NAMES
    assert rows_of(got) == plain([r[:2] for r in rows])
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS piece", "3 AS block", "4 AS n", "5 AS pair")
    assert rows_of(alignment.align(docs, A, B, 1000)) == plain([r[:2] for r in rows])
    assert alignment.align(docs.limit(0), A, B).count() == 0


def test_query_on_its_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    got = alignment.op12_token_alignment(spark, f"{TESTDATA}/sf0.001")
    assert rows_of(got) == plain([tuple(r) for r in docs.collect()])


def test_tokens_that_do_not_spell_the_text():
    side = alignment.Vocabulary(None, [b"ab", b"c", b"d"])
    texts = pa.array(["abc", "abd", "", "cab", "c", "abx"])
    ids = np.array([0, 1, 0, 2, 1, 0, 2, 0, 2])
    at = np.array([0, 2, 4, 4, 6, 7, 9])
    assert alignment.equal_bytes(texts, side, ids, at).tolist() == [True, True, True, True, False, False]
