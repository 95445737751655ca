"""Operator 13: the prefix trie of conversations, with subtree totals by parallel tree contraction.

Prefixes are told apart by 128 bits that can be worked out for every turn at once; no turn waits for the one before. Then
rounds of joins take the tree apart: *rake* takes off all leaves and adds their totals to their parents, *compress* takes
nodes out of chains of only children and links child and grandparent. What was taken out of chains is put back in reverse
order, which gives every node the total of its subtree, in rounds of the order of the logarithm of the tree's size, also
where one conversation is a chain of millions of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_job, stored, task_count

FAMILY = 5  # conversations that share the beginning of the first of them
MOST_SHARED = 8  # turns
RUN = 1024  # turns whose prefixes are worked out together
IDS_AT_ONCE = 10_000  # ids in one piece of a list of ids
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, i`` (from 1), digests ``e1, e2`` and ``size`` in bytes of each turn, in order. Nulls are empty.

    Turns of one number are ordered by a digest of role and text. Sorted by range over all tasks, so that a
    conversation of any length is numbered without being in one.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("e1"),
        F.xxhash64(F.lit(2), role, text).alias("e2"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    order = (F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("e1"), F.col("e2"))
    spread = rows.repartitionByRange(task_count(spark), *order).sortWithinPartitions(*order)
    spread = spread.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    spread = stored(spark, spread.drop("turn"), "turns")
    # A row for each conversation and task it reaches into.
    runs = spread.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(spark, runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "runs")
    i = F.col("at") - F.col("first") + F.col("before") + 1
    return spread.join(runs, ["conv_id", "part"]).select("conv_id", i.alias("i"), "e1", "e2", "size")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as ``conv_id, length`` and their turns as ``conv_id, pos, e1, e2, size``, beginnings shared."""
    spark = numbered.sparkSession
    sizes = numbered.groupBy("conv_id").agg(F.max("i").alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    own = sizes.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    lender = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    take = F.least("h", F.coalesce("base_n", F.lit(0)))
    plan = own.join(lender, "base", "left").select("conv_id", "n", "h", "base", take.alias("take"))
    plan = stored(spark, plan, "rebuilding")
    kept = numbered.join(plan.select("conv_id", "h", "take"), "conv_id").filter("i > h")
    kept = kept.select("conv_id", (F.col("i") - F.col("h") + F.col("take")).alias("pos"), "e1", "e2", "size")
    first = numbered.filter(F.col("i") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    lent = first.join(plan.select("conv_id", "base", "take"), "base").filter("i <= take")
    lent = lent.select("conv_id", F.col("i").alias("pos"), "e1", "e2", "size")
    length = F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return plan.select("conv_id", length.alias("length")), kept.unionByName(lent)


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, size``, the key ``p1, p2`` of the turns up to this one and ``q1, q2`` of those before it.

    A key is the exclusive or of hashes of position and turn, so runs of turns are taken on their own and put together.
    """
    spark = rows.sparkSession
    keyed = rows.select(
        "conv_id",
        "pos",
        "size",
        F.xxhash64(F.lit(11), "pos", "e1", "e2").alias("k1"),
        F.xxhash64(F.lit(12), "pos", "e2", "e1").alias("k2"),
        F.floor((F.col("pos") - 1) / RUN).alias("run"),
    )
    keyed = stored(spark, keyed, "rebuilt")
    totals = keyed.groupBy("conv_id", "run").agg(F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("conv_id", "run", *(F.bit_xor(k).over(before).alias(f"c{k[1]}") for k in ("k1", "k2")))
    within = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.select("*", *(F.bit_xor(k).over(within).alias(f"l{k[1]}") for k in ("k1", "k2")))
    met = local.join(stored(spark, carry.filter("run > 0"), "carry"), ["conv_id", "run"], "left")
    p1, p2 = (F.col(f"l{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0))) for k in (1, 2))
    met = met.select("conv_id", "pos", "size", "k1", "k2", p1.alias("p1"), p2.alias("p2"))
    q1, q2 = (F.col(f"p{k}").bitwiseXOR(F.col(f"k{k}")) for k in (1, 2))
    return stored(spark, met.select("conv_id", "pos", "size", "p1", "p2", q1.alias("q1"), q2.alias("q2")), "prefixes")


def trie_nodes(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id`` (smallest member), ``depth, p1, p2, parent_conv_id, n_convs, size`` of each node.

    A node is named by its smallest member and its depth.
    """
    spark = steps.sparkSession
    # Every conversation is a member once at each depth; partial sums before the shuffle, so no node is hot.
    grouped = steps.groupBy(F.col("pos").alias("depth"), "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("size").alias("size"),
        F.min("q1").alias("q1"),
        F.min("q2").alias("q2"),
    )
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    root = root.select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("size"),
                       zero.alias("q1"), zero.alias("q2"))
    nodes = stored(spark, grouped.unionByName(root), "nodes")
    # Both sides come from files and get a shuffle of their own, so a parent of very many children can be split.
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                         F.col("conv_id").alias("parent_conv_id"))
    met = nodes.join(above, ["depth", "q1", "q2"], "left")
    return stored(spark, met.select("conv_id", "depth", "p1", "p2", "parent_conv_id", "n_convs", "size"), "tree")


def priority(conv_id: Column, depth: Column) -> Column:
    """Of neighbours in a chain the one with the smaller value goes: in an unbroken chain every second one."""
    return F.struct(depth.bitwiseAND(-depth).alias("bit"), F.xxhash64(conv_id, depth).alias("tie"))


NAME = ["conv_id", "depth"]


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``conv_id, depth, leaves, saved``: both values of each node summed over its subtree.

    ``nodes`` has ``conv_id, depth, parent_conv_id, kids`` (children) and the values. A node that is still in the tree
    carries in ``leaves, saved`` what its raked children gave, and in ``x_leaves, x_saved`` what nodes that were
    compressed between it and its present parent had.
    """
    spark = nodes.sparkSession
    zero = F.lit(0).cast("bigint")
    live = stored(
        spark,
        nodes.select(*NAME, F.col("parent_conv_id").alias("p_conv"), (F.col("depth") - 1).alias("p_depth"), "kids", "leaves",
                     "saved", zero.alias("x_leaves"), zero.alias("x_saved")),
        "live",
    )
    raked, removed = [], []
    while not live.isEmpty():
        leaf = live.filter("kids = 0")
        raked.append(leaf.select(*NAME, "leaves", "saved"))
        given = leaf.filter("p_conv IS NOT NULL").groupBy(F.col("p_conv").alias("conv_id"), F.col("p_depth").alias("depth"))
        given = given.agg(
            F.sum(F.col("leaves") + F.col("x_leaves")).alias("g_leaves"),
            F.sum(F.col("saved") + F.col("x_saved")).alias("g_saved"),
            F.count(F.lit(1)).alias("g_kids"),
        )
        rest = live.filter("kids > 0").join(given, NAME, "left")
        rest = rest.select(
            *NAME, "p_conv", "p_depth", "x_leaves", "x_saved",
            *((F.col(c) + F.coalesce(f"g_{c}", zero)).alias(c) for c in ("leaves", "saved")),
            (F.col("kids") - F.coalesce("g_kids", zero)).alias("kids"),
        )
        rest = stored(spark, rest, "raked")
        live, gone = compress(rest)
        if gone is not None:
            removed.append(gone)
    known = raked[0].limit(0) if raked else nodes.select(*NAME, "leaves", "saved").limit(0)
    for some in raked:
        known = known.union(some)
    # Back in reverse: a node waits for the child it was compressed with, whose total is known by then.
    for gone in reversed(removed):
        child = known.select(F.col("conv_id").alias("w_conv"), F.col("depth").alias("w_depth"),
                             F.col("leaves").alias("w_leaves"), F.col("saved").alias("w_saved"))
        total = gone.join(child, ["w_conv", "w_depth"]).select(
            *NAME, *((F.col(c) + F.col(f"w_{c}")).alias(c) for c in ("leaves", "saved"))
        )
        known = known.union(stored(spark, total, "expanded"))
    return known


def compress(rest: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The tree without some nodes that have one child, and those nodes: what they had, and the child they wait for.

    A node goes if no neighbour that could go too has priority, so no two neighbours go at once.
    """
    spark = rest.sparkSession
    marked = rest.withColumn("lone", (F.col("kids") == 1) & (F.col("depth") > 0))
    if marked.filter("lone").isEmpty():
        return rest, None
    marked = marked.withColumn("rank", F.when(F.col("lone"), priority(F.col("conv_id"), F.col("depth"))))
    above = marked.filter("lone").select(F.col("conv_id").alias("p_conv"), F.col("depth").alias("p_depth"), F.col("rank").alias("p_rank"))
    met = marked.join(above, ["p_conv", "p_depth"], "left")
    met = stored(spark, met.withColumn("first", F.col("lone") & (F.col("p_rank").isNull() | (F.col("rank") < F.col("p_rank")))), "met")
    lone = met.filter("first").select(
        F.col("conv_id").alias("p_conv"), F.col("depth").alias("p_depth"), F.col("rank").alias("v_rank"),
        F.col("p_conv").alias("v_conv"), F.col("p_depth").alias("v_depth"),
        *(F.col(c).alias(f"v_{c}") for c in ("leaves", "saved", "x_leaves", "x_saved")),
    )
    pairs = met.drop("p_rank").join(lone, ["p_conv", "p_depth"], "left")
    goes = F.col("v_rank").isNotNull() & (F.col("rank").isNull() | (F.col("v_rank") < F.col("rank")))
    pairs = stored(spark, pairs.withColumn("goes", goes), "pairs")
    gone = pairs.filter("goes").select(
        F.col("p_conv").alias("conv_id"), F.col("p_depth").alias("depth"),
        F.col("conv_id").alias("w_conv"), F.col("depth").alias("w_depth"),
        *((F.col(f"v_{c}") + F.col(f"x_{c}")).alias(c) for c in ("leaves", "saved")),
    )
    stays = pairs.join(gone.select(*NAME), NAME, "left_anti").select(
        *NAME,
        F.when(F.col("goes"), F.col("v_conv")).otherwise(F.col("p_conv")).alias("p_conv"),
        F.when(F.col("goes"), F.col("v_depth")).otherwise(F.col("p_depth")).alias("p_depth"),
        "kids", "leaves", "saved",
        *(
            (F.col(f"x_{c}") + F.when(F.col("goes"), F.col(f"v_{c}") + F.col(f"v_x_{c}")).otherwise(0)).alias(f"x_{c}")
            for c in ("leaves", "saved")
        ),
    )
    return stored(spark, stays, "live"), gone


KEY = ["depth", "p1", "p2"]


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key's ids, in order, as comma-joined text of bounded size."""
    key, ids = None, []
    out: list[tuple] = []
    for batch in batches:
        for *one, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if one != key or len(ids) >= IDS_AT_ONCE:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = one, []
            ids.append(conv_id)
        if len(out) >= 1000:
            yield told(out, [*KEY, "first", "ids"])
            out = []
    if ids:
        out.append((*key, ids[0], ",".join(map(str, ids))))
    if out:
        yield told(out, [*KEY, "first", "ids"])


def told(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, pa.string() if n in ("ids", "ends_sha256") else pa.int64()) for n, c in zip(names, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key, over its runs in order; a run is held at a time."""
    key, digest = None, hashlib.sha256()
    out: list[tuple] = []
    for batch in batches:
        for *one, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if one == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = one, hashlib.sha256()
            digest.update(ids.encode())
        if len(out) >= 1000:
            yield told(out, [*KEY, "ends_sha256"])
            out = []
    if key is not None:
        out.append((*key, digest.hexdigest()))
    if out:
        yield told(out, [*KEY, "ends_sha256"])


def end_digests(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """``depth, p1, p2, ends_sha256`` of the nodes at which conversations end."""
    tasks = task_count(steps.sparkSession)
    zero = F.lit(0).cast("bigint")
    last = steps.select("conv_id", F.col("pos").alias("length"), "p1", "p2").join(conversations, ["conv_id", "length"])
    none = conversations.filter("length = 0").select("conv_id", "length", zero.alias("p1"), zero.alias("p2"))
    ends = last.unionByName(none).select(F.col("length").alias("depth"), "p1", "p2", "conv_id")
    # Many conversations may end at one node: their ids are joined range by range before they meet.
    ends = ends.repartitionByRange(tasks, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    runs = arrow_job(ends, listed, "depth bigint, p1 bigint, p2 bigint, first bigint, ids string")
    runs = runs.repartition(tasks, *KEY).sortWithinPartitions(*KEY, "first")
    return arrow_job(runs, digested, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` for each trie node.

    Conversations are rebuilt first: those of one family of five share the first turns of its first member. Null turns
    come first, turns of one number by a digest of their content; null roles and texts are empty; repeated rows are turns
    of their own; rows without conv_id take part in nothing; other columns are ignored, whatever their names; an empty
    table gives no rows. Prefixes are compared by 128 bits of hashes.
    """
    spark = conversations.sparkSession
    numbered = stored(spark, turns(conversations), "numbered")
    lengths, rows = rebuilt(numbered)
    steps = prefixes(rows)
    nodes = trie_nodes(steps, lengths)
    children = nodes.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    tree = nodes.join(children, NAME, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    tree = stored(spark, tree, "tree-children")
    sums = subtree_sums(
        tree.select(
            *NAME, "parent_conv_id", F.col("n_children").alias("kids"),
            (F.col("n_children") == 0).cast("bigint").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        )
    )
    done = tree.join(sums, NAME).join(end_digests(steps, lengths), KEY, "left")
    return done.select(
        *NAME, "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = """
WITH ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, max(i) AS n,
         -- crc32 of the decimal id, bit by bit
         xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda k: ascii(substr(c::VARCHAR, k, 1))::BIGINT)),
            lambda crc, b: list_reduce(
              list_prepend(xor(crc, b), range(8)::BIGINT[]),
              lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
          )) % 9 AS h
  FROM ordered GROUP BY c
), plan AS (
  SELECT a.c, a.n, a.h, a.c - a.c % 5 AS base, least(a.h, coalesce(b.n, 0)) AS take
  FROM sizes a LEFT JOIN sizes b ON b.c = a.c - a.c % 5
), rebuilt AS (
  SELECT p.c, o.i - p.h + p.take AS pos, role, text FROM ordered o JOIN plan p ON o.c = p.c AND o.i > p.h
  UNION ALL
  SELECT p.c, o.i, role, text FROM ordered o JOIN plan p ON o.c = p.base AND o.i <= p.take
), steps AS (
  SELECT c, 0 AS depth, '' AS prefix, 0 AS size FROM sizes
  UNION ALL
  SELECT c, pos,
         string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING),
         strlen(text)
  FROM rebuilt
), member AS (
  SELECT c, depth, size, min(c) OVER (PARTITION BY depth, prefix) AS conv_id, max(depth) OVER (PARTITION BY c) AS length
  FROM steps
), nodes AS (
  SELECT conv_id, depth, count(*) AS n_convs, max(size) AS size,
         sha256(coalesce(string_agg(CASE WHEN length = depth THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM member GROUP BY conv_id, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN member p ON p.c = n.conv_id AND p.depth = n.depth - 1
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), valued AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (conv_id, depth)
), sums AS (
  SELECT m.conv_id, m.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((v.n_convs - 1) * v.size) AS saved_tokens
  FROM valued v JOIN member m ON m.c = v.conv_id AND m.depth <= v.depth GROUP BY ALL
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM valued JOIN sums USING (conv_id, depth)
"""
