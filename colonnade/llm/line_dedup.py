"""Operator 2: line dedup. Lines that many documents share go, except in one of them. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import bind, documents, lines, lower_ascii, stored, strip

#: A line counts from this many code points on, and goes if at least this many documents hold it.
MIN_LENGTH = 40
MIN_DOCUMENTS = 5


def line_keys(text: Column, min_length: int) -> Column:
    """For each line its number and, if it is long enough, the digest of its key."""
    def key(line: Column, i: Column) -> Column:
        stripped = strip(line)
        digest = F.when(F.length(stripped) >= min_length, F.unhex(F.md5(lower_ascii(stripped))))
        return F.struct(i.alias("i"), digest.alias("key"))

    return F.filter(F.transform(lines(text), key), lambda line: line["key"].isNotNull())


def shared_lines(keyed: DataFrame, min_documents: int) -> DataFrame:
    """Keys of at least ``min_documents`` documents, with the largest id that holds each.

    ``keyed``: ``_id`` and ``_key``, a row per document and key. The distinct count is split over ids before it
    meets under its key, so a line that every document holds is counted by many tasks.
    """
    once = keyed.groupBy("_key", "_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        once.groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_documents"), F.max("_id").alias("_holder"))
        .filter(F.col("_documents") >= min_documents)
        .select("_key", "_holder")
    )


def drop_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, into: str = "line_dedup"
) -> DataFrame:
    """The documents with a struct column ``into``: ``n_lines``, ``n_dropped`` and the ``text`` that stays.

    Only digests go through the counting shuffles; the texts are shuffled once, to meet the numbers of the lines
    they lose. A null text reads as one empty line and becomes an empty text; texts of any length are split whole.
    Rows that share a doc_id are one document; a null doc_id is one document, smaller than all others, so of equal
    lines the one in the largest id stays. Repeated rows are all returned; an empty table stays empty. Columns of any
    name go through as they are, but one called ``into`` is replaced.
    """
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = docs.select(row.alias("_row"), F.explode(line_keys(F.col("text"), min_length)).alias("_line"))
    found = found.select(
        "_row", F.col("_row.id").alias("_id"), F.col("_line.i").alias("_i"), F.col("_line.key").alias("_key")
    )
    # Read from files, the shared keys get a shuffle of their own, so a line that very many documents hold can be split.
    shared = stored(docs.sparkSession, shared_lines(found, min_documents), "shared-lines")
    lost = found.join(shared, "_key").filter(~F.col("_id").eqNullSafe(F.col("_holder")))
    numbers = lost.groupBy("_row").agg(F.collect_set("_i").alias("_lost"))
    # The caller's columns stay in a struct of their own until the end.
    whole = docs.select(F.struct("*").alias("_doc"), row.alias("_row"), F.col("text").alias("_text"))
    joined = whole.join(numbers, whole["_row"].eqNullSafe(numbers["_row"]), "left")

    def rebuilt(parts: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(parts) - 1)
        kept = F.when(F.col("_lost").isNull(), F.array_join(parts, "\n")).otherwise(
            F.array_join(F.transform(F.array_except(every, F.col("_lost")), lambda i: parts[i]), "\n")
        )
        return F.struct(
            F.size(parts).cast("bigint").alias("n_lines"),
            F.coalesce(F.size("_lost"), F.lit(0)).cast("bigint").alias("n_dropped"),
            kept.alias("text"),
        )

    done = joined.select("_doc", bind(lines(F.col("_text")), rebuilt).alias("_into"))
    kept = [done["_doc"][name].alias(name) for name in docs.columns if name.lower() != into.lower()]
    return done.select(*kept, done["_into"].alias(into))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("line_dedup.n_lines").alias("n_lines"),
        F.col("line_dedup.n_dropped").alias("n_dropped"),
        F.sha2(F.col("line_dedup.text"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, i, ls[i] AS line,
         regexp_replace(ls[i], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS s
  FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)
), k AS (
  SELECT r, doc_id, i, line,
         translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= {MIN_LENGTH}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
), marked AS (
  SELECT r, k.doc_id, i, line, holder IS NOT NULL AND holder <> k.doc_id AS lost
  FROM k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
