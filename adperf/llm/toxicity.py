"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models, toxic and ordinary, predict each character of a word from those before it. Orders above SHARED have counts of
their own class; the orders below are continuation counts over both classes, so an expression that is rare in both gets nearly
the same probability from either and says little. A word's evidence is the difference of its log-likelihoods; a passage of
PASSAGE words has the sum divided by PASSAGE, and a document the largest of its passages, so that a long text cannot
dilute an insult. A logistic curve, fitted on labelled rows that the counts have not seen, turns that into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import id_fold, only_one, whole_text
from adperf.llm.tokens import Kept

ORDER = 5
SHARED = 2
DISCOUNT = 0.75
PASSAGE = 8
THRESHOLD = 0.7
# The classifier is fitted on about so many labelled documents of each class, drawn by a hash of their ids.
SAMPLE = 8_000
WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


class KneserNey:
    """Log-likelihood ratios from the n-gram counts of both classes (orders SHARED + 1 to ORDER, ``^`` and ``$`` at word ends)."""

    def __init__(self, toxic: dict[str, int], ordinary: dict[str, int], cache: int = 100_000):
        self.counts = (ordinary, toxic)
        self.contexts = tuple(self._contexts(c) for c in self.counts)
        # Shared continuation counts: by how many different characters a shorter gram is preceded, over both classes.
        grams = {g for c in self.counts for g in c if len(g) == SHARED + 1}
        self.shared: list[tuple[dict, dict]] = [({}, {})] * (SHARED + 1)
        for n in range(SHARED, 0, -1):
            continued = Counter(g[1:] for g in grams)
            self.shared[n] = (continued, self._contexts(continued))
            grams = set(continued)
        self.floor = 1.0 / (len(grams) + 1)
        self.ratios = Kept(self._ratio, cache)
        self.words = Kept(self._word, cache)

    @staticmethod
    def _contexts(counts: dict[str, int]) -> dict[str, tuple[int, int]]:
        """Context -> (count, number of different characters that follow)."""
        out: dict[str, tuple[int, int]] = {}
        for gram, n in counts.items():
            total, kinds = out.get(gram[:-1], (0, 0))
            out[gram[:-1]] = (total + n, kinds + 1)
        return out

    @staticmethod
    def _interpolated(gram: str, counts: dict, contexts: dict, lower: float) -> float:
        seen = contexts.get(gram[:-1])
        if seen is None:
            return lower
        total, kinds = seen
        return (max(counts.get(gram, 0) - DISCOUNT, 0.0) + DISCOUNT * kinds * lower) / total

    def _ratio(self, gram: str) -> float:
        """log P(last character | those before, toxic) - log P(... | ordinary)."""
        p = self.floor
        for n in range(1, min(SHARED, len(gram)) + 1):
            p = self._interpolated(gram[-n:], *self.shared[n], p)
        logs = []
        for counts, contexts in zip(self.counts, self.contexts):
            q = p
            for n in range(SHARED + 1, len(gram) + 1):
                q = self._interpolated(gram[-n:], counts, contexts, q)
            logs.append(math.log(q))
        return logs[1] - logs[0]

    def _word(self, word: str) -> float:
        marked = f"^{word}$"
        return sum(self.ratios[marked[max(0, i - ORDER + 1) : i + 1]] for i in range(1, len(marked)))

    def evidence(self, text: str) -> float:
        """The largest length-normalised log-likelihood ratio of a passage; 0 for a text without a word."""
        found = words(text)
        if not found:
            return 0.0
        each = np.fromiter(map(self.words.__getitem__, found), np.float64, len(found))
        sums = np.concatenate([[0.0], np.cumsum(each)])
        width = min(PASSAGE, len(found))
        return float((sums[width:] - sums[:-width]).max() / PASSAGE)


def logistic(evidence: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, both classes with equal weight (Newton steps, slightly regularised)."""
    weight = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    x = np.stack([evidence, np.ones_like(evidence)], axis=1)
    beta, ridge = np.zeros(2), np.diag([1e-4, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + ridge @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


class Model:
    """What the tasks get: n-gram counts and the logistic curve. Each Python worker builds the tables once."""

    def __init__(self, key: str, toxic: dict, ordinary: dict, slope: float = 0.0, intercept: float = 0.0):
        self.key, self.toxic, self.ordinary, self.slope, self.intercept = key, toxic, ordinary, slope, intercept

    def ratios(self) -> KneserNey:
        return only_one(("toxicity", self.key), lambda: KneserNey(self.toxic, self.ordinary))

    def score(self, text: str) -> float:
        if not self.toxic or not self.ordinary:
            return 0.0
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.ratios().evidence(text) + self.intercept))))


def _sample(labels: DataFrame, size: int) -> DataFrame:
    """About ``size`` ids of each class, by hash: (doc_id, toxic, fits). ``fits`` rows make the counts, others the curve."""
    marked = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.filter(id_fold("doc_id", 3) != 1)
    n = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, min(1.0, size / max(1, n.get(1, 0)))).otherwise(min(1.0, size / max(1, n.get(0, 0))))
    fits = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(8)), F.lit(4)) > 0
    return marked.filter(draw < share).select("doc_id", F.col("toxic").cast("int").alias("toxic"), fits.alias("fits"))


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """A model from a bounded sample of labelled rows outside the held-out fold; equal texts of the sample count once.

    At most about 2 * ``size`` documents reach the model, whatever the table's size; their ids are broadcast, so the
    documents are scanned once and not shuffled. Without rows of both classes the model scores everything 0.
    """
    spark = docs.sparkSession
    text = whole_text(docs)
    ids = _sample(labels, size)
    sample = docs.select("doc_id", text.alias("text")).join(F.broadcast(ids), "doc_id")
    sample = sample.groupBy("text").agg(F.max("toxic").alias("toxic"), F.max("fits").alias("fits"))

    def grams(batches):
        for batch in batches:
            toxic, gram = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for word in set(words(text)):
                    marked = f"^{word}$"
                    for n in range(SHARED + 1, ORDER + 1):
                        found = [marked[i : i + n] for i in range(len(marked) - n + 1)]
                        gram += found
                        toxic += [label] * len(found)
                if len(gram) > 500_000:
                    yield _counted(toxic, gram)
                    toxic, gram = [], []
            yield _counted(toxic, gram)

    counted = sample.filter("fits").select("text", "toxic").mapInArrow(grams, "toxic int, gram string, n long")
    table = counted.groupBy("toxic", "gram").agg(F.sum("n").alias("n")).toArrow()
    classes: dict[int, dict] = {0: {}, 1: {}}
    for label, gram, n in zip(*(table.column(c).to_pylist() for c in ("toxic", "gram", "n"))):
        classes[label][gram] = n
    model = Model(f"{spark.sparkContext.applicationId}-{id(classes)}", classes[1], classes[0])
    if not model.toxic or not model.ordinary:
        return model
    held = evidence(sample.filter("NOT fits").select("toxic", "text"), model).toArrow()
    label, found = np.array(held.column("toxic").to_pylist(), float), np.array(held.column("evidence").to_pylist(), float)
    if 0 < label.sum() < len(label):
        model.slope, model.intercept = logistic(found, label)
    else:  # too few labelled rows for a curve: half-way at one nat a word
        model.slope, model.intercept = 2.0, -2.0
    return model


def _counted(toxic: list[int], gram: list[str]) -> pa.RecordBatch:
    n = Counter(zip(toxic, gram))
    columns = [[k[0] for k in n], [k[1] for k in n], list(n.values())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64()))], ["toxic", "gram", "n"])


def evidence(sample: DataFrame, model: Model) -> DataFrame:
    """(toxic, evidence) of labelled texts."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [shared.value.ratios().evidence(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64())], ["toxic", "evidence"])

    return sample.mapInArrow(run, "toxic int, evidence double")


def scorer(spark, model: Model):
    """A column function: the score of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(shared.value.score).astype("float64")

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of THRESHOLD on) of every row's whole text.

    Learned from labelled rows whose crc32(doc_id) mod 3 is not 1; ``held_out`` marks the others. NULL and empty texts score as
    texts without evidence. NULL ids are scored and never learned from; repeated rows are scored one by one; of several
    labels of an id the toxic one holds. Other columns are ignored; an empty table gives no rows.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, size))
    scored = docs.select("doc_id", (id_fold("doc_id", 3) == 1).alias("held_out"), score(whole_text(docs)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, unchanged, that are not predicted toxic."""
    score = scorer(docs.sparkSession, fit(docs, labels, size))
    return docs.filter(score(whole_text(docs)) < THRESHOLD)
