"""Nearest vectors against brute force."""

import numpy as np
import pytest
from conftest import TESTDATA

from colonnade.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k, every):
    """Each query's nearest by plain loops over all rows."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if usable(i, v)]
    dims = max((len(v) for _, v in good), default=0)
    padded = [(i, np.append(v, np.zeros(dims - len(v)))) for i, v in good]
    out = {}
    for query in {i for i, _ in padded if i % every == 0}:
        found = {}
        for q in (v for i, v in padded if i == query):
            for i, v in padded:
                if i != query:
                    found[i] = max(found.get(i, -np.inf), (q * v).sum())
        out[query] = sorted(found.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def usable(i, v):
    return i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def held(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def check(got, want, least=0.9):
    assert set(got) == {q for q, found in want.items() if found}
    hits = total = 0
    for query, found in got.items():
        assert len(found) == len(want[query])
        assert found == sorted(found, key=lambda p: (-p[1], p[0])) and len({i for i, _ in found}) == len(found)
        hits += len({i for i, _ in found} & {i for i, _ in want[query]})
        total += len(found)
    assert hits >= least * total
    return hits / max(total, 1)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def test_query_on_its_table(spark):
    table = spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet")
    want = brute_force([(r.vec_id, r.embedding) for r in table.collect()], 20, 20)
    got = held(nearest.op11_nearest_vectors(spark, f"{TESTDATA}/sf0.1"))
    check(got, want, 0.95)
    scores = {q: dict(found) for q, found in want.items()}
    assert all(abs(scores[q].get(i, s) - s) < 1e-12 for q, found in got.items() for i, s in found)


def test_few_rows_are_found_exactly(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.integers(-9, 9, 5).astype(float).tolist()) for i in range(30)]
    rows += [(20, rows[3][1]), (31, rows[4][1]), (32, rows[4][1]), (32, rows[4][1]), (40, rows[0][1])]
    rows += [(41, None), (42, []), (43, [0.0] * 5), (44, [1.0, None, 2.0, 0.0, 1.0]), (45, [float("nan")] * 5)]
    rows += [(46, [float("inf"), 1.0]), (None, [1.0] * 5), (47, [3.0, 1.0]), (-20, [1.0] * 5), (60, [5.0] * 7)]
    frame = vectors(spark, rows).selectExpr("*", "1 AS list", "2 AS shard", "3 AS query_id", "4 AS vector", "5 AS rank")
    for k in (3, 20, 100):
        want = brute_force(rows, k, 20)
        got = held(nearest.nearest_vectors(frame, nearest.F.col("vec_id") % 20 == 0, k))
        assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}
    assert nearest.nearest_vectors(frame.limit(0), nearest.F.col("vec_id") % 20 == 0).count() == 0
    alone = vectors(spark, [(20, [1.0, 2.0])])
    assert nearest.nearest_vectors(alone, nearest.F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("kind", ["spread", "copies", "lengths"])
def test_recall_over_many_lists_and_shards(spark, monkeypatch, kind):
    for name, value in (("LIST_ROWS", 40), ("SHARD_ROWS", 150), ("CHUNK", 16), ("CELLS", 500)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2400, 48))
    if kind == "copies":  # a third of all rows are near copies, a tenth exact ones
        x[:800] = x[0] + rng.normal(size=(800, 48)) * 0.05
        x[800:1040] = x[800]
    if kind == "lengths":
        x *= rng.uniform(0.2, 3, (2400, 1))
    order = rng.permutation(2400)
    rows = [(int(i), np.float32(v).tolist()) for i, v in zip(order, x, strict=True)]
    got = held(nearest.nearest_vectors(vectors(spark, rows), nearest.F.col("vec_id") % 20 == 0))
    check(got, brute_force(rows, 20, 20), 0.9)


def test_candidates_are_given_up_early():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    turn = nearest.rotation(64)
    lists = nearest.Lists(np.zeros((1, 64)), turn)
    vectors = pa.array([v.tolist() for v in x])
    rows = next(nearest.indexer(lists, 4)(iter([pa.RecordBatch.from_arrays([pa.array(range(2048)), vectors[:2048]], names=["i", "v"])])))
    queries = pa.table(
        {"query_id": [-1, -2], "vector": [x[2999].tobytes(), x[2998].tobytes()], "tau": [-np.inf] * 2, "lists": pa.array([[0], [0]], pa.list_(pa.int32()))}
    )
    scan = nearest.Scan(pa.Table.from_batches([rows]), queries, turn, 4, 20)
    scan.run(queries.column("lists"))
    for k in range(2):
        want = np.argsort(-(x[:2048] @ x[2999 - k]))[:20]
        assert set(scan.found[1][scan.found[0] == k]) == set(want.tolist())
    assert scan.seen[0] == 4096 and scan.seen[-1] < 0.75 * scan.seen[0]
