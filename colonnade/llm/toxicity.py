"""Operator 10: toxicity from the nearest labelled examples.

A text is a TF-IDF vector over word beginnings that tell toxic examples from others. Its nearest examples by cosine are
found exactly with a block-max inverted index: examples stand in blocks, each block has the largest weight of every
term, so a block whose bound is below the neighbours found so far is skipped. Neighbours vote with their similarity;
the vote is calibrated on the examples themselves, each judged by the others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import arrow_job, chosen, documents
from colonnade.llm.language_id import fold

EXAMPLES = 6000  # of each label at most, from all over the labelled rows
TERMS = 4000  # word beginnings at most
BEGINNINGS = (4, 5, 6, 7, 8)  # lengths in characters; shorter words count whole
LEVELS = 4  # a term's first, second, third and fourth occurrence are weighed apart
LEAST_CHI2 = 15.0
NEIGHBOURS = 25
BLOCK = 64  # examples to a block of the index
SHRINK = 2.0  # similarity that the votes of a lone neighbour are weighed against
THRESHOLD = 0.7
SCORED = "row bigint, score double, evidence array<struct<doc_id: bigint, label: int, similarity: double>>"


def spaced(text: Column) -> Column:
    """Lower-case words with one blank before each."""
    letters = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " ")
    return F.concat(F.lit(" "), F.ltrim(letters))


# ---- examples and terms -----------------------------------------------------------------------------------


def examples(docs: DataFrame, labels: DataFrame, per_label: int = EXAMPLES) -> tuple[DataFrame, dict[int, float]]:
    """At most some ``per_label`` documents of each label (``doc_id, text, label``), and how many rows one stands for.

    A hash of the ids in ``labels`` (``doc_id``, ``label`` 0 or 1) decides. The ids, whose number is bounded by the
    parameter, go to the documents, which are not shuffled; equal texts of a label are one example.
    """
    picked, weights = [], {}
    for label in (0, 1):
        ids, rate = chosen(labels.filter(F.col("label") == label), per_label, 10 + label)
        picked.append(ids.withColumn("label", F.lit(label)))
        weights[label] = 1 / rate
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    found = docs.select("doc_id", "text").filter("text IS NOT NULL").join(ids, "doc_id")
    found = found.select("doc_id", "label", spaced(F.col("text")).alias("text"))
    once = found.groupBy(F.xxhash64("text").alias("hash"), "label").agg(
        F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id")
    )
    return once.select("doc_id", "text", "label"), weights


def select_terms(sample: DataFrame, weights: dict[int, float], most: int = TERMS) -> list[str]:
    """Word beginnings that toxic examples hold more often, by chi-square; of nested equals the longest."""
    found = F.filter(F.split(F.ltrim("text"), " "), lambda word: word != "")
    cut = F.array_distinct(F.flatten(F.transform(F.array_distinct(found), lambda w: F.array(
        *(F.substring(w, 1, k) for k in BEGINNINGS)))))
    held = sample.select("label", F.explode(cut).alias("term")).groupBy("term").agg(
        F.sum(F.col("label")).alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    a, b = F.col("toxic"), F.col("clean")
    n = n1 + n0
    chi2 = n * F.pow(a * (n0 - b) - b * (n1 - a), 2) / (F.lit(float(n1)) * n0 * (a + b) * (n - a - b) + 1e-9)
    rated = held.filter((a >= 3) & (a * n0 > 3 * b * n1)).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
    rows = rated.orderBy(F.desc("chi2"), "term").limit(2 * most).collect()
    counts = {r.term: (r.toxic, r.clean) for r in rows}
    nested = {t[:k] for t in counts for k in BEGINNINGS if k < len(t) and counts.get(t[:k]) == counts[t]}
    return [r.term for r in rows if r.term not in nested][:most]


def automaton(terms: list[str]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        machine.add_word(" " + term, number)
    machine.make_automaton()
    return machine


def counted(machine, text: str) -> Counter:
    return Counter(number for _, number in machine.iter(text))


# ---- the index --------------------------------------------------------------------------------------------


@dataclass
class Index:
    """Examples in blocks: ``weights`` holds a row of normalised weights for each (term and level)."""

    terms: list[str]
    idf: np.ndarray  # by dimension: term * LEVELS + level
    doc_ids: list[int | None]
    labels: np.ndarray
    share: np.ndarray  # rows of the table an example stands for, by example
    postings: list[tuple[np.ndarray, np.ndarray]]  # by dimension: examples and weights
    bounds: list[tuple[np.ndarray, np.ndarray]]  # by dimension: blocks and the largest weight in each
    line: tuple[float, float] = (1.0, 0.0)  # calibration: log-odds = slope * logit(vote) + offset
    empty: float = 0.0  # score of a text without any term

    @property
    def blocks(self) -> int:
        return -(-len(self.doc_ids) // BLOCK)

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        dims = np.array([t * LEVELS + k for t, n in sorted(counts.items()) for k in range(min(n, LEVELS))], np.int64)
        weights = self.idf[dims] if len(dims) else np.zeros(0)
        norm = math.sqrt(float(weights @ weights))
        return (dims, weights / norm) if norm else (dims[:0], weights[:0])

    def nearest(self, dims: np.ndarray, weights: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The examples of the largest positive cosines, most similar first; of equals the first in the index.

        Blocks are opened in the order of their bounds until no unopened one can hold a closer example.
        """
        bound = np.zeros(self.blocks)
        for dim, weight in zip(dims.tolist(), weights.tolist(), strict=True):
            blocks, most = self.bounds[dim]
            bound[blocks] += weight * most
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, like = np.zeros(0, np.int64), np.zeros(0)
        step = 8
        for at in range(0, len(order), step):
            if len(like) >= NEIGHBOURS and bound[order[at]] < like[NEIGHBOURS - 1] - 1e-12:
                break
            opened = np.sort(order[at : at + step])
            where = np.full(self.blocks, -1)
            where[opened] = np.arange(len(opened))
            scores = np.zeros(len(opened) * BLOCK)
            for dim, weight in zip(dims.tolist(), weights.tolist(), strict=True):
                docs, values = self.postings[dim]
                edges = np.searchsorted(docs, np.stack([opened, opened + 1]) * BLOCK)
                for k, (b, e) in enumerate(edges.T.tolist()):
                    if b < e:
                        scores[docs[b:e] - opened[k] * BLOCK + k * BLOCK] += weight * values[b:e]
            hit = np.flatnonzero(scores > 0)
            found = opened[hit // BLOCK] * BLOCK + hit % BLOCK
            hit, found = hit[found != skip], found[found != skip]
            best, like = np.concatenate([best, found]), np.concatenate([like, scores[hit]])
            top = np.lexsort((best, -like))[:NEIGHBOURS]
            best, like = best[top], like[top]
        return best, like

    def vote(self, best: np.ndarray, like: np.ndarray) -> float:
        """Similarity-weighted share of toxic rows among the neighbours, drawn towards that of texts without terms."""
        weight = like * like * self.share[best]
        scale = SHRINK * float(self.share.min())
        return float((weight @ self.labels[best] + scale * self.empty) / (weight.sum() + scale))

    def score(self, vote: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.line[0] * logit(vote) + self.line[1]))))


def logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def fit_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one number, a few Newton steps with a small penalty."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    penalty = np.diag([1e-3, 1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - penalty @ (beta - np.array([1.0, 0.0]))
        step = np.linalg.solve((design.T * (weight * p * (1 - p))) @ design + penalty + 1e-9 * np.eye(2), slope)
        beta = beta + np.clip(step, -2, 2)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, per_label: int = EXAMPLES, most_terms: int = TERMS) -> Index:
    """Learn from the ``docs`` that ``labels`` names (0 or 1); what is kept is bounded by the parameters.

    Rows without text, label or id are left out; with no row of either label every score is that of no evidence.
    """
    sample, weights = examples(docs, labels, per_label)
    sample = sample.persist()
    try:
        terms = select_terms(sample, weights, most_terms)
        pairs = sample.select("doc_id", "label", "text") if terms else sample.limit(0)
        counts = arrow_job(pairs, term_counter(terms), "doc_id bigint, label int, terms array<int>")
        rows = counts.orderBy("label", "doc_id").collect()
        labels = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        sample.unpersist()
    found = [(r.doc_id, r.label, Counter(r.terms)) for r in rows]
    return build(terms, found, labels, weights)


def build(terms: list[str], found: list[tuple], labels: dict[int, int], weights: dict[int, float]) -> Index:
    held = np.zeros(len(terms) * LEVELS)
    total = sum(n * weights.get(label, 1.0) for label, n in labels.items()) or 1.0
    for _, label, counts in found:
        for term, n in counts.items():
            held[term * LEVELS : term * LEVELS + min(n, LEVELS)] += weights.get(label, 1.0)
    idf = np.log((total + 1) / (held + 1)) + 1
    used = [x for x in found if x[2]]
    # Toxic and clean examples with alike terms side by side make the bounds of blocks tight.
    used.sort(key=lambda x: (sorted(x[2])[:3], x[0] is None, x[0] or 0))
    toxic = sum(1 for x in found if x[1] == 1 and not x[2]) * weights.get(1, 1.0)
    clean = (labels.get(0, 0) - sum(1 for x in used if x[1] == 0)) * weights.get(0, 1.0)
    index = Index(
        terms, idf, [x[0] for x in used], np.array([x[1] for x in used], float),
        np.array([weights.get(x[1], 1.0) for x in used]), [], [],
        empty=toxic / (toxic + clean) if toxic + clean else 0.0,
    )
    vectors = [index.vector(x[2]) for x in used]
    dims = np.concatenate([v[0] for v in vectors] or [np.zeros(0, np.int64)])
    values = np.concatenate([v[1] for v in vectors] or [np.zeros(0)])
    owner = np.repeat(np.arange(len(used)), [len(v[0]) for v in vectors])
    order = np.lexsort((owner, dims))
    edges = np.searchsorted(dims[order], np.arange(len(idf) + 1))
    for begin, end in zip(edges[:-1], edges[1:], strict=True):
        docs, weight = owner[order[begin:end]], values[order[begin:end]]
        firsts = np.flatnonzero(np.diff(docs // BLOCK, prepend=-1))
        index.postings.append((docs, weight))
        index.bounds.append((docs[firsts] // BLOCK, np.maximum.reduceat(weight, firsts) if len(docs) else weight))
    if used and len(set(index.labels)) == 2:
        votes = [index.vote(*index.nearest(*v, skip=k)) for k, v in enumerate(vectors)]
        x = np.array([logit(v) for v in votes])
        index.line = fit_line(x, index.labels, index.share / index.share.mean())
    return index


def term_counter(terms: list[str]) -> Callable:
    """The Arrow task that lists each text's terms, as often as they occur (LEVELS times at most)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(terms)
        for batch in batches:
            found = [
                [t for t, n in counted(machine, text).items() for _ in range(min(n, LEVELS))]
                for text in batch.column(2).to_pylist()
            ]
            arrays = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "label", "terms"])

    return count


def scorer(shared, evidence: int) -> Callable:
    """The Arrow task that scores texts against the index."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        machine = automaton(index.terms) if index.terms else None
        for batch in batches:
            scores, shown = [], []
            for text in batch.column(1):
                dims, weights = index.vector(counted(machine, text.as_py()) if machine else Counter())
                if not len(dims):
                    scores.append(index.empty)
                    shown.append([])
                    continue
                best, like = index.nearest(dims, weights)
                scores.append(index.score(index.vote(best, like)))
                shown.append([
                    {"doc_id": index.doc_ids[i], "label": int(index.labels[i]), "similarity": float(s)}
                    for i, s in zip(best[:evidence].tolist(), like[:evidence].tolist(), strict=True)
                ])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))
            arrays = [batch.column(0), pa.array(scores, pa.float64()), pa.array(shown, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "score", "evidence"])

    return score


def score_toxicity(docs: DataFrame, index: Index, evidence: int = 3) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``evidence`` (the nearest examples) for each row of ``docs``.

    Null and empty texts have no terms and get the score of such texts; whole texts are read; repeated rows are
    scored alike; a null doc_id stays; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("row"), spaced(F.col("text")).alias("text"))
    found = arrow_job(rows, scorer(shared, evidence), SCORED)
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return found.select(F.col("row").alias("doc_id"), "score", predicted.alias("predicted"), "evidence")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    known = labels.filter(F.coalesce(fold(3) != 1, F.lit(False)) & F.col("label").isNotNull())
    index = fit(docs, known)
    scored = score_toxicity(docs, index)
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", "evidence")
