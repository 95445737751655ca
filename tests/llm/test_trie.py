"""The prefix trie against plain loops and SQL."""

import hashlib
import random
import zlib

import duckdb
from conftest import TESTDATA

from colonnade.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def remainder(a, b):
    """SQL's: with the sign of the first."""
    return a - b * int(a / b)


def plain(rows):
    """The contract with dictionaries of prefixes."""
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            found.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in found.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        now = own.get(c - remainder(c, 5), [])[:h] + own[c][h:]
        for d in range(len(now) + 1):
            members.setdefault(tuple(now[:d]), []).append((c, len(now) == d))
    kids, out = {}, []
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    for p, held in members.items():
        ends = ",".join(map(str, sorted(c for c, end in held if end)))
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(c for c, _ in held), len(p), parent, len(held), len(kids.get(p, [])), *sums[p], digest))
    return sorted(out, key=repr)


def nodes(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=repr)


def sample(seed=3):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 60), 100, 101, 104, 205]:
        for t in range(rng.choice([1, 2, 3, 6, 9, 12])):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "é€", ""]) if rng.random() < 0.8 else None))
    rows += [(300, t, "user", "x" * (t % 3)) for t in range(40)]  # a long chain
    rows += [(301, 0, None, "only"), (302, None, "user", "null turn first"), (302, 0, "user", None), (None, 1, "user", "no id")]
    rng.shuffle(rows)
    return rows


def test_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN", 7)
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 2)
    rows = sample()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS i", "3 AS pos", "4 AS part", "5 AS p1", "6 AS size")
    assert nodes(trie.prefix_trie(frame)) == plain(rows)


def test_copies_ties_and_nothing(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(40) for t in range(3)]
    rows += [(1000, 1, "user", "same"), (1000, 1, "user", "same"), (1001, None, "user", "same"), (1001, None, "user", "same")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert nodes(trie.prefix_trie(frame)) == plain(rows)
    assert trie.prefix_trie(frame.limit(0)).count() == 0


def test_query_equals_sql(spark):
    for table in ("sf0.001", "sf0.01"):
        path = f"{TESTDATA}/{table}/conversations.parquet"
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
        want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({trie.ORACLE})").fetchall(), key=repr)
        got = nodes(trie.op13_prefix_trie(spark, f"{TESTDATA}/{table}"))
        assert got == want == plain(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())


def test_chains_go_in_few_rounds(spark, monkeypatch):
    rounds, plainly = [], trie.compress
    monkeypatch.setattr(trie, "compress", lambda rest: rounds.append(1) or plainly(rest))
    rows = [(d, d + 1, d if d else None, 1 if d < 399 else 0, int(d == 399), 1) for d in range(400)]
    tree = [(0, depth, None if depth == 0 else 0, kids, leaf, one) for depth, (_, _, _, kids, leaf, one) in enumerate(rows)]
    frame = spark.createDataFrame(tree, "conv_id long, depth long, parent_conv_id long, kids long, leaves long, saved long")
    got = {r.depth: (r.leaves, r.saved) for r in trie.subtree_sums(frame).collect()}
    assert got == {d: (1, 400 - d) for d in range(400)} and len(rounds) <= 12
