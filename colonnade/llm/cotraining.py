"""Operator 6: quality classification by co-training.

Two classifiers see a document from two sides: one its words, one its metadata (source, language, size) and the layout of
the page. Each labels the unlabelled documents it is sure of for the other, round by round, out of all there are. Their
probabilities are calibrated on labelled documents that trained neither, and combined to one score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import chosen, documents, lines, stored, strip, words

LABELLED = 8000  # labelled rows to learn from, at most (expected number)
ROUNDS = 3
SURE = 0.95  # a view passes on a document it gives a class at least this probability
SHARE = 0.25  # of the unlabelled documents that a view passes on in one round, at most (expected number)
STEP = 1e-3  # of log-odds, in which documents are counted to find how sure a view must be
KEEP = 0.3
WORD_FEATURES = 1 << 15
NAME_FEATURES = 64
LAYOUT = (
    "log_words", "log_lines", "word_length", "distinct_words", "capitals", "digits", "marks", "blank_share",
    "closed_lines", "distinct_lines", "words_per_line",
)
VIEWS = ("text", "meta")


#: Everything but capitals, digits, marks and white space: most of a text, taken out in one pass.
PLAIN = r"[^\p{Lu}\p{N}\p{P}\p{S}\s]+"
CLOSING = ".!?:;\"')"


def describe(docs: DataFrame) -> DataFrame:
    """``row`` (doc_id), the words' tokens, the names and the layout of each document.

    Nulls read as empty; empty texts have no tokens; whole texts count, however long; repeated rows are described alike;
    other columns are ignored, whatever their names.
    """
    names = F.array(
        F.concat(F.lit("source="), F.coalesce(F.col("source").cast("string"), F.lit(""))),
        F.concat(F.lit("lang="), F.coalesce(F.col("lang").cast("string"), F.lit(""))),
    )
    rows = docs.select(F.col("doc_id").alias("row"), names.alias("names"), F.coalesce("text", F.lit("")).alias("text"))
    # What several measures need is a column of its own, so that it is worked out once.
    rows = rows.select(
        "row",
        "names",
        F.length("text").alias("size"),
        words(F.lower("text")).alias("tokens"),
        F.filter(lines(F.col("text")), lambda line: strip(line) != "").alias("filled"),
        F.regexp_replace("text", PLAIN, "").alias("kinds"),
    )
    rows = rows.withColumn("seen", F.regexp_replace("kinds", r"\s+", ""))
    rows = rows.withColumn("marks", F.regexp_replace("seen", r"[\p{Lu}\p{N}]+", ""))
    rows = rows.withColumn("digits", F.regexp_replace("seen", r"[\p{Lu}\p{P}\p{S}]+", ""))
    n = F.greatest(F.size("tokens"), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size("filled"), F.lit(1)).cast("double")
    size = F.greatest("size", F.lit(1)).cast("double")
    closed = F.filter("filled", lambda line: F.instr(F.lit(CLOSING), F.right(F.rtrim(line), F.lit(1))) > 0)
    marks, digits = F.length("marks"), F.length("digits")
    layout = {
        "log_words": F.log1p(n),
        "log_lines": F.log1p(n_lines),
        "word_length": (F.col("size") - (F.length("kinds") - F.length("seen"))) / n,
        "distinct_words": F.size(F.array_distinct("tokens")) / n,
        "capitals": (F.length("seen") - marks - digits) / size,
        "digits": digits / size,
        "marks": marks / size,
        "blank_share": (F.length("kinds") - F.length("seen")) / size,
        "closed_lines": F.size(closed) / n_lines,
        "distinct_lines": F.size(F.array_distinct("filled")) / n_lines,
        "words_per_line": F.log1p(n / n_lines),
    }
    return rows.select("row", "tokens", "names", *(layout[name].cast("double").alias(name) for name in LAYOUT))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (of the id and the text) and the vectors ``counts``, ``named`` and ``plain`` of each row."""
    rows = describe(docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("doc_id", "text").alias("key"))))
    for stage in (
        HashingTF(inputCol="tokens", outputCol="counts", numFeatures=WORD_FEATURES),
        HashingTF(inputCol="names", outputCol="named", numFeatures=NAME_FEATURES, binary=True),
        VectorAssembler(inputCols=list(LAYOUT), outputCol="plain"),
    ):
        rows = stage.transform(rows)
    return rows.select("row.doc_id", "row.key", "counts", "named", "plain")


def views() -> Pipeline:
    """Feature vectors ``text`` and ``meta`` from what ``measured`` gives."""
    return Pipeline(
        stages=[
            Normalizer(inputCol="counts", outputCol="text", p=2.0),
            StandardScaler(inputCol="plain", outputCol="scaled", withMean=True, withStd=True),
            VectorAssembler(inputCols=["named", "scaled"], outputCol="meta"),
        ]
    )


def learner(view: str) -> LogisticRegression:
    return LogisticRegression(featuresCol=view, labelCol="label", weightCol="weight", regParam=2e-4, maxIter=30,
                              probabilityCol=f"p_{view}", rawPredictionCol=f"raw_{view}", predictionCol=f"says_{view}")


def logits(scored: DataFrame, model: LogisticRegressionModel, view: str) -> DataFrame:
    """The view's log-odds as ``z_<view>``."""
    found = model.transform(scored).withColumn(f"z_{view}", vector_to_array(f"raw_{view}")[1])
    return found.drop(f"raw_{view}", f"p_{view}", f"says_{view}")


def probability(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


@dataclass
class CoTrained:
    features: PipelineModel
    models: dict[str, LogisticRegressionModel]
    scales: dict[str, tuple[float, float]]  # calibrated log-odds of a view: slope and offset
    joint: tuple[float, float, float]  # of both views: two slopes and an offset


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> CoTrained | None:
    """Learn from ``docs`` (columns of documents) and ``labels`` (``doc_id``, ``label`` 0 or 1).

    A hash of the ids picks a bounded number of labelled documents, a fifth of which is kept for calibration. All
    documents count for the scale of the layout, and all without a label can get a pseudo-label. Rows equal in id
    and text count once. None if there are no labels, or of one class only.
    """
    return _learn(stored(docs.sparkSession, _placed(docs), "described"), labels, rounds)


def _placed(docs: DataFrame) -> DataFrame:
    return measured(docs).withColumn("place", F.monotonically_increasing_id())


def _learn(rows: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> CoTrained | None:
    """``co_train`` of stored rows of ``_placed``. Labels meet ids and places; no vectors are shuffled."""
    spark = rows.sparkSession
    labels = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL")
    named, _ = chosen(labels, LABELLED, 1)
    taken = labels.join(F.broadcast(named), "doc_id").groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    once = rows.groupBy("doc_id", "key").agg(F.min("place").alias("place"))
    free = once.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").select("place")
    known = stored(spark, once.join(F.broadcast(taken), "doc_id").select("place", "label"), "labelled")
    if known.isEmpty():
        return None
    features = views().fit(rows)
    rows = features.transform(rows).select("place", "key", *VIEWS).withColumn("weight", F.lit(1.0))
    free = _among(rows, free).withColumn("label", F.lit(None).cast("double"))
    known = rows.join(F.broadcast(known), "place").persist()
    try:
        held = F.pmod("key", F.lit(5)) == 0
        train, check = known.filter(~held), known.filter(held)
        if min(x.select("label").distinct().count() for x in (train, check)) < 2:
            return None
        models = {view: learner(view).fit(train) for view in VIEWS}
        most = SHARE * free.count()
        for round_ in range(1, rounds + 1):
            told = {
                other: sure(free, models[view], view, int(most * round_)).select(train.columns)
                for view, other in zip(VIEWS, reversed(VIEWS), strict=True)
            }
            models = {view: learner(view).fit(train.unionByName(told[view])) for view in VIEWS}
        judged = check
        for view in VIEWS:
            judged = logits(judged, models[view], view)
        judged = judged.select("label", "weight", *(f"z_{view}" for view in VIEWS)).persist()
        scales = {view: tuple(_line(judged, [f"z_{view}"])) for view in VIEWS}
        for view, (slope, offset) in scales.items():
            judged = judged.withColumn(f"z_{view}", slope * F.col(f"z_{view}") + offset)
        joint = tuple(_line(judged, [f"z_{view}" for view in VIEWS]))
        return CoTrained(features, models, scales, joint)
    finally:
        known.unpersist()


def _among(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The rows at these places. They go to the rows as bitmaps, a bit for each place.

    A bitmap stands for 32,768 places; the table of them grows with the rows, so Spark's own size check decides whether
    it is broadcast.
    """
    bitmaps = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    bitmaps = stored(rows.sparkSession, bitmaps, "unlabelled")
    bit = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("bucket", F.bitmap_bucket_number("place")).join(bitmaps, "bucket")
    return found.filter(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0).drop("bucket", "bits")


def sure(free: DataFrame, model: LogisticRegressionModel, view: str, most: int) -> DataFrame:
    """The rows of ``free`` that the view gives a class at least ``SURE``, with that ``label`` and half the weight.

    If these are more than ``most``, the surest: rows are counted by steps of log-odds, and of the last step that
    fits in part a hash of the key decides. Nothing is sorted or gathered.
    """
    z = F.greatest(F.least(F.col(f"z_{view}"), F.lit(30.0)), F.lit(-30.0))
    p = probability(z)
    found = logits(free, model, view).filter((p >= SURE) | (p <= 1 - SURE))
    found = found.withColumn("step", F.floor(F.abs(z) / STEP))
    room, least, share = most, -1, 1.0
    for step, n in sorted(found.groupBy("step").count().collect(), reverse=True):
        if n > room:
            least, share = step, room / n
            break
        room -= n
    place = F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(1 << 40)) / float(1 << 40)
    found = found.filter((F.col("step") > least) | ((F.col("step") == least) & (place < share)))
    return found.withColumn("label", (z > 0).cast("double")).withColumn("weight", F.lit(0.5))


def _line(rows: DataFrame, columns: list[str]) -> list[float]:
    """Slopes and offset of a logistic regression on a few numbers."""
    clipped = [F.greatest(F.least(F.col(c), F.lit(30.0)), F.lit(-30.0)).alias(c) for c in columns]
    table = VectorAssembler(inputCols=columns, outputCol="z").transform(rows.select("label", *clipped))
    model = LogisticRegression(featuresCol="z", labelCol="label", regParam=1e-3, maxIter=50).fit(table)
    return [*model.coefficients.toArray().tolist(), float(model.intercept)]


def score_quality(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """``doc_id, p_text, p_meta, score, kept`` for each row of ``docs`` (columns of documents).

    Null texts read as empty, other nulls as empty names; whole texts count; repeated rows are scored alike; without
    a model every score is 0.5. Other columns are ignored.
    """
    if model is None:
        half = F.lit(0.5)
        return docs.select("doc_id", half.alias("p_text"), half.alias("p_meta"), half.alias("score"), F.lit(True).alias("kept"))
    return _scored(measured(docs), model)


def _scored(rows: DataFrame, model: CoTrained) -> DataFrame:
    scored = model.features.transform(rows).select("doc_id", *VIEWS)
    for view in VIEWS:
        scored = logits(scored, model.models[view], view)
        slope, offset = model.scales[view]
        scored = scored.withColumn(f"z_{view}", slope * F.col(f"z_{view}") + offset).drop(view)
    first, second, offset = model.joint
    clipped = {v: F.greatest(F.least(F.col(f"z_{v}"), F.lit(30.0)), F.lit(-30.0)) for v in VIEWS}
    score = probability(first * clipped["text"] + second * clipped["meta"] + offset)
    return scored.select(
        "doc_id",
        probability(F.col("z_text")).alias("p_text"),
        probability(F.col("z_meta")).alias("p_meta"),
        score.alias("score"),
        (score >= KEEP).alias("kept"),
    )


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = stored(spark, _placed(docs), "described")
    model = _learn(rows, labels)
    return _scored(rows, model) if model else score_quality(docs, None)
