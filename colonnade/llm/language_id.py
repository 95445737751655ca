"""Operator 1: language identification by compression.

A text is compressed with a zstandard dictionary of each language; the language that makes it smallest wins. A
dictionary is raw text of that language. Where the two smallest sizes are nearly equal the answer is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_job, documents

UNKNOWN = "und"
SAMPLE_TEXTS = 200  # for each language at most this many pieces
SAMPLE_CHARS = 400  # of this many characters make its dictionary
BLOCK_BYTES = 4096  # a text is compressed in blocks, so that the dictionary counts throughout
LEVEL = 9
MIN_MARGIN = 0.01  # of the second smallest size; below it the answer is rejected
STEEPNESS = 40.0  # of the score as the margin grows
MAX_LANGUAGES = 500
PREDICTED = "row bigint, best string, rejected boolean, score double"


def plain(text: Column) -> Column:
    """Lower-case letters in runs, one blank between them: marks, digits and case say little about a language."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " ")


def dictionaries(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """For each ``lang`` of ``labelled`` (``lang``, ``text``) at most ``texts`` * ``chars`` characters of its texts.

    Frequent languages come first. Which texts and which part of each is decided by a hash, so the sample comes from the whole table. It is
    bounded by the number of languages, of which there may be 500. Rows without label or text are left out.
    """
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", plain(F.col("text")).alias("text"), F.xxhash64("text").alias("hash")
    )
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{len(counts)} languages; at most {MAX_LANGUAGES} are learned")
    rates = {lang: min(1.0, 3 * texts / n) for lang, n in counts.items()}
    rate = F.create_map(*(F.lit(x) for pair in rates.items() for x in pair))[F.col("lang")]
    position = F.pmod("hash", F.lit(1 << 40)) / float(1 << 40)
    begin = F.pmod(F.xxhash64("hash"), F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1
    piece = F.substring(F.col("text"), begin, F.lit(chars))
    sample = usable.filter(position < rate).select("lang", "hash", piece.alias("piece")).distinct()
    pieces: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "hash").collect():
        pieces.setdefault(row.lang, []).append(row.piece)
    order = sorted(pieces, key=lambda lang: (-counts[lang], lang))
    return {lang: "\n".join(pieces[lang][:texts]).encode() for lang in order}


def classifier(samples: dict[str, bytes]) -> Callable:
    """The Arrow task: for each row its language, whether the margin is too narrow, and a score."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressors = []
        for sample in samples.values():
            data = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            compressors.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False))
        names = list(samples)

        def judge(text: bytes) -> tuple[str, bool, float]:
            sizes = [0] * len(names)
            for begin in range(0, len(text), BLOCK_BYTES):
                block = text[begin : begin + BLOCK_BYTES]
                for k, compressor in enumerate(compressors):
                    sizes[k] += len(compressor.compress(block))
            order = sorted(range(len(names)), key=lambda k: sizes[k])  # of equal ones the first
            best = order[0]
            if len(order) == 1:
                return names[best], False, 1.0
            margin = 1 - sizes[best] / sizes[order[1]]
            # The share of the best among all languages if each loses by its own margin.
            share = 1 / sum(math.exp(-STEEPNESS * (sizes[k] / sizes[best] - 1)) for k in order)
            return names[best], margin < MIN_MARGIN, share

        for batch in batches:
            judged = [
                judge(bytes(text.as_buffer())) if readable.as_py() and names else (UNKNOWN, False, 0.0)
                for text, readable in zip(batch.column(1), batch.column(2), strict=True)
            ]
            best, rejected, score = zip(*judged, strict=True) if judged else ((), (), ())
            arrays = [batch.column(0), pa.array(best, pa.string()), pa.array(rejected, pa.bool_()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "best", "rejected", "score"])

    return classify


def identify(docs: DataFrame, samples: dict[str, bytes], key: str = "doc_id") -> DataFrame:
    """``key``, ``best`` (language of the smallest size), ``lang`` (``und`` if rejected), ``rejected``, ``score``.

    Whole texts are compressed, block by block. Null texts and texts without a letter are ``und`` with score 0, as
    are all texts if nothing was learned; equal sizes go to the language with more rows to learn from; repeated rows are judged alike, null
    keys stay; other columns are ignored.
    """
    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(key).cast("bigint").alias("row"), plain(F.col("text")).alias("text"),
                       readable.alias("readable"))
    judged = arrow_job(rows, classifier(samples), PREDICTED)
    lang = F.when(F.col("rejected"), UNKNOWN).otherwise(F.col("best"))
    return judged.select(F.col("row").alias(key), "best", lang.alias("lang"), "rejected", "score")


def fold(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learned = dictionaries(docs.filter(F.coalesce(fold(4) != 2, F.lit(False))).select("lang", "text"))
    found = identify(docs.select("doc_id", "text"), learned)
    held_out = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, F.col("best").alias("lang_pred"), "score", "rejected")
