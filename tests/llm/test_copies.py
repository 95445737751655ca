"""Passages, near copies and components against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_tables import SCHEMA, ascii_lower, awkward, frame, sentence, words, write_tables

from colonnade.llm import near_dedup, passages
from colonnade.llm.arrays import lists, window_hashes, window_starts
from colonnade.llm.components import components, union_find


def removed(rows, width=50):
    """What each row loses; rows of one id are one document, rows without id stand alone."""
    least = {}
    for doc_id, text in rows:
        found = words(text)
        for i in range(len(found) - width + 1):
            key = tuple(found[i : i + width])
            if doc_id is not None:
                least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        found = words(text)
        gone = [False] * len(found)
        for i in range(len(found) - width + 1):
            if doc_id is not None and least[tuple(found[i : i + width])] < doc_id:
                gone[i : i + width] = [True] * width
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((doc_id, len(found), sum(gone), kept))
    return sorted(out, key=repr)


def passage_rows():
    rng = random.Random(3)
    shared, other = sentence(rng, 130).split(), sentence(rng, 49).split()
    rows = [(r[0], r[1]) for r in awkward()]
    for i in range(100, 140):
        begin, size = rng.randrange(60), rng.choice([30, 49, 50, 51, 70])
        parts = [sentence(rng, rng.randrange(40)), " ".join(shared[begin : begin + size]), " ".join(other)]
        rng.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    rows += [(200, rows[-1][1]), (201, rows[-1][1]), (15, "another row of this id " * 20), (90, "same " * 49), (91, "same " * 51)]
    return rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_passages_by_brute_force(spark, conf, partitions):
    conf(spark__sql__shuffle__partitions=str(partitions))
    rows = passage_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.selectExpr("*", "1 AS places", "'x' AS version", "2 AS n_words")
    got = [tuple(r) for r in passages.remove_repeats(spark, docs).collect()]
    assert sorted(got, key=repr) == removed(rows)


def test_passage_digests_and_empty_tables(spark, tmp_path):
    rows = awkward()
    got = passages.op4_passages(spark, write_tables(spark, tmp_path / "t", rows)).collect()
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in removed([r[:2] for r in rows])]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert passages.remove_repeats(spark, frame(spark, rows).limit(0)).count() == 0


def test_packed_entries_survive():
    rng = np.random.default_rng(1)
    for ids in (np.array([[5], [2**62], [-7]]), np.array([[5, 1], [6, -(2**60)], [6, 3]])):
        counts = np.array([3, 1, 400])
        places = np.concatenate([[0, 254, 100_000], [70_000], np.cumsum(rng.integers(1, 600, 400))])
        for kind in (np.uint32, np.uint64):
            hashes = rng.integers(0, 2**32 - 1, len(places)).astype(kind)
            back = passages.unpack(memoryview(passages.pack(ids, counts, places, hashes)))
            assert all((a == b).all() for a, b in zip(back, (ids, counts, places, hashes)))


def test_window_hashes_depend_on_the_words_alone():
    import pyarrow as pa

    rng = random.Random(2)
    row = [rng.randrange(2**62) for _ in range(60)]
    values, offsets = lists(pa.array([row[:9], [], row, row[30:], [1, 2]], pa.list_(pa.int64())).slice(1))
    for width in (5, 25):
        starts = window_starts(offsets, width)
        hashes = dict(zip(starts.tolist(), window_hashes(values, starts, width).tolist()))
        assert len(starts) == (60 - width + 1) + (30 - width + 1)
        assert [hashes[30 + i] for i in range(30 - width + 1)] == [hashes[60 + i] for i in range(30 - width + 1)]
        assert len(set(hashes.values())) == 60 - width + 1


def shingles(text):
    found = words(ascii_lower(text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def grouped(rows):
    """Smallest reachable id by id, and set sizes by row; rows of one id are one document."""
    sets = [(d, shingles(t)) for d, t in rows]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and 100 * len(x & y) >= 75 * len(x | y):
                links.append((a, b))
    top = union_find(links)
    return sorted(((d, len(x), top.get(d, d), d is None or top.get(d, d) == d) for d, x in sets), key=repr)


def near_rows():
    rng = random.Random(11)
    rows = [(r[0], r[1]) for r in awkward()]
    base = sentence(rng, 90, 10_000).split()
    for i in range(300, 420):  # one group with copies from slightly to heavily edited
        text = list(base)
        for _ in range(rng.randrange(12)):
            text[rng.randrange(90)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    for i in range(500, 530):  # tiny sets
        rows.append((i, sentence(rng, rng.randrange(1, 8), 3)))
    return rows


def test_near_copies_by_brute_force(spark, conf):
    conf(spark__sql__shuffle__partitions="5")
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("*", "1 AS component_id", "2 AS id")
    got = sorted(map(tuple, near_dedup.near_duplicates(spark, docs).collect()), key=repr)
    assert got == grouped(rows)
    assert near_dedup.near_duplicates(spark, docs.limit(0)).count() == 0


def test_centers_in_several_chunks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CENTERS_AT_ONCE", 7)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.near_duplicates(spark, docs).collect()), key=repr) == grouped(rows)


def test_pairs_are_verified_without_a_look_at_signatures(spark):
    """With ``least_like`` 0 signatures that agree nowhere lose no link, where the default would drop the pairs."""
    rows = list(enumerate(groups_in_one_bucket()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(spark, docs.repartition(3), least_like=0)
    assert sorted(map(tuple, got.collect()), key=repr) == grouped(rows)
    places = near_dedup.ROWS * near_dedup.BANDS
    sketch = lambda k: np.full(places, k, np.uint8).tobytes()
    names = "bucket chunk kind node component band main sketch n".split()
    dealt = [(1, 0, 0, 5, 5, 0, 1, sketch(1), 9), (1, 0, 1, 1, 1, 0, 1, sketch(2), 9), (1, 0, 1, 2, 1, 0, 1, sketch(3), 9)]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in dealt])
    found = lambda least: [tuple(r.values()) for b in near_dedup.candidate_finder(least)(iter([batch])) for r in b.to_pylist()]
    assert found(0) == [(1, 5), (2, 5)] and found(near_dedup.LEAST_LIKE) == []


def groups_in_one_bucket():
    """A passage that all share and tails of a few kinds: buckets that hold several groups."""
    rng = random.Random(5)
    shared, tails = sentence(rng, 60), [sentence(rng, 30 + 10 * k) for k in range(4)]
    return [f"{shared} {tails[i % 4]} {sentence(rng, 2)}" for i in range(40)]


def test_buckets_stream_over_batches():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    bucket = np.sort(rng.integers(0, 40, 90))
    node = np.concatenate([np.sort(rng.choice(1000, (bucket == b).sum(), replace=False)) for b in np.unique(bucket)])
    # Single rows go, except in the first and the last bucket: those may go on in another partition.
    edges = (bucket[0], bucket[-1])
    want = [(b, n, node[bucket == b][0]) for b, n in zip(bucket, node) if (bucket == b).sum() > 1 or b in edges]
    for size in (1, 2, 7, 90):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(x[i : i + size]) for x in (bucket, bucket * 0, node)], names=list("abc"))
            for i in range(0, 90, size)
        ]
        got = [(r["bucket"], r["node"], r["lo"]) for b in near_dedup._meets(iter(batches)) for r in b.to_pylist()]
        assert got == want


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 1400).astype(np.uint64)
    errors = []
    for shared in (200, 500, 900):
        x, y = np.sort(pool[:1000]), np.sort(pool[1000 - shared : 1000 - shared + 1000][: 1000])
        exact = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        one, two = near_dedup.signatures_of([x, y], 420)
        errors.append(abs((one == two).mean() - exact))
    assert max(errors) < 0.08
    # Every place is taken, whatever the size of the set, and cutting the elements into chunks changes nothing.
    small = near_dedup.signatures_of([pool[:1], pool[:3], pool], 64)
    assert (small < np.uint64(64 << 32)).all()
    old, near_dedup.ELEMENTS_AT_ONCE = near_dedup.ELEMENTS_AT_ONCE, 100
    try:
        assert (near_dedup.signatures_of([pool[:1], pool[:3], pool], 64) == small).all()
    finally:
        near_dedup.ELEMENTS_AT_ONCE = old


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)]
    links += [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)] + [(7, 7), (3000, -5)]
    rng.shuffle(links)
    found = spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long").repartition(6)
    got = {r.node: r.component for r in components(spark, found).collect()}
    want = union_find([x for x in links if x[0] != x[1]])
    assert got == want
    assert components(spark, found.limit(0)).count() == 0


def test_near_query_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    assert near_dedup.op5_near_dedup(spark, folder).count() == 0
    assert passages.op4_passages(spark, folder).count() == 0


def test_buckets_cut_at_partition_edges_lose_no_row():
    rows = [(b, 3, n) for b, nodes in ((1, [5]), (2, [1, 2]), (4, [7]), (5, [3, 8, 9]), (6, [4]), (9, [1, 6])) for n in nodes]

    def met(part, batch):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part[i : i + batch])], names=["bucket", "band", "node"])
            for i in range(0, len(part), batch)
        ]
        return [(r["bucket"], r["node"]) for b in near_dedup._meets(iter(batches)) for r in b.to_pylist()]

    several = {(b, n) for b, _, n in rows if b in (2, 5, 9)}
    for cut in range(len(rows) + 1):
        for batch in (1, 2, 3, 100):
            parts = [p for p in (rows[:cut], rows[cut:]) if p]
            got = [x for p in parts for x in met(p, batch)]
            edges = {(p[i][0], p[i][2]) for p in parts for i in (0, -1)}
            assert len(got) == len(set(got)) and several <= set(got) <= several | edges
