"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns documents with the columns of
``documents``; the last returns the pieces of the packed sequences. Stages are written and read again between steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import documents, stored
from colonnade.llm.decontamination import contaminated
from colonnade.llm.line_dedup import drop_lines
from colonnade.llm.near_dedup import near_duplicates
from colonnade.llm.packing import pack_documents
from colonnade.llm.quality_rules import apply_rules
from colonnade.llm.tokens import tokenizer_path


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go; very long ones are judged whole; repeated rows alike; columns of any name
    go through; an empty table stays empty. Texts of a language without stop words (``lang``) are judged by the other rules.
    """
    name = fresh(docs, "quality")
    return apply_rules(docs, into=name, lang="lang" if "lang" in docs.columns else None).filter(F.col(name)["kept"]).select(*docs.columns)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the one of the largest id; ``n_chars`` follows the text.

    Null texts become empty ones; texts are split whole, however long; repeated rows and rows of one id are one document
    and are all returned; columns of any name go through; an empty table stays empty.
    """
    name = fresh(docs, "lines")
    done = drop_lines(docs, into=name)
    text = F.col(name)["text"]
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return done.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id; rows without id all stay.

    Texts without words are linked with nothing and stay; long ones are compared whole; rows of one id stay or go
    together; columns of any name go through; an empty table stays empty.
    """
    kept = near_duplicates(spark, docs.select("doc_id", "text")).filter("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    return named.unionByName(docs.filter("doc_id IS NULL"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and empty texts hold none; long ones are searched to their end; rows are told apart by 64 bits of id and text, so
    repeated rows go together and others of the same id stay; columns of any name go through; an empty table, or
    benchmark, changes nothing.
    """
    row, name = F.xxhash64("doc_id", "text"), fresh(docs, "row")
    found = contaminated(docs.select(row.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, row).join(leaks, name, "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, ids and all.

    Null and empty texts are the end id alone; long ones are cut into pieces; repeated rows are packed each; other columns
    are ignored; an empty table gives no pieces.
    """
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("line dedup", shared_lines),
    ("near dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]
#: Token ids can't be worked out in SQL; the rows are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
