"""Language identification by nearest centroids of TF-IDF character n-gram vectors.

A text's vector holds counts of its 1- to 3-character n-grams (lower case, letters only, one space between words), damped
by the logarithm, weighted by inverse document frequency and normalised. The GRAMS n-grams that most texts of a bounded sample
have are its dimensions; all others count towards its length as the rarest, so a text gains nothing by being long. Each
language has up to CENTROIDS centroids, found by spherical k-means over the sample. The nearest centroid by cosine gives the
language; a text is rejected when it lies farther from it than nearly all texts of that language and of about its length, with
a margin.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import id_fold, only_one, stored, whole_text

GRAMS = 8192  # known n-grams; all are named by 32-bit hashes
CENTROIDS = 3
# The centroids are fitted on about so many documents of each language, and at most about SAMPLE_ALL in total.
SAMPLE, SAMPLE_ALL = 500, 4_000
# A text is rejected when its cosine is below REJECT times the quantile LOW of its language's texts in the sample, in the
# band of its number of distinct n-grams; each text's cosine is taken with centroids of the sample's half without it. Bands
# with fewer than FEW texts take in their neighbours.
REJECT, LOW, FEW = 0.5, 0.01, 50
EDGES = (256, 512, 1024, 2048)
SPACE = 32

def letters() -> np.ndarray:
    """For each code point, whether it is a letter. A worker that makes it gives up the tables of an earlier stage."""
    return only_one("letters", lambda: np.array([chr(c).isalpha() for c in range(0x110000)]))


def frequencies(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct n-grams of a whole text, in order of their hashes, and their damped counts; None without a letter."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[code]
    if not is_letter.any():
        return None
    code = np.where(is_letter, code, SPACE)
    code = np.concatenate([[SPACE], code, [SPACE]]).astype(np.uint32)
    code = code[np.concatenate([[True], (code[1:] != SPACE) | (code[:-1] != SPACE)])]
    one = code * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (code[1:] + np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (code[2:] + np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    grams, counts = np.unique(np.concatenate([one[code != SPACE], two, three]), return_counts=True)
    return grams, np.log1p(counts).astype(np.float32)


def placed(grams: np.ndarray, counts: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, float]:
    """Counts of the known n-grams (sorted hashes), and the sum of the others' squares."""
    vector = np.zeros(len(known), np.float32)
    if not len(known):
        return vector, float(counts @ counts)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    hit = known[at] == grams
    vector[at[hit]] = counts[hit]
    return vector, float(counts[~hit] @ counts[~hit])


class Centroids:
    """Languages, their centroids (rows of a matrix), the known n-grams and their weights, the weight of all others, and for
    each centroid and band the lowest cosine that is accepted."""

    def __init__(self, names: list[str], matrix: np.ndarray, known: np.ndarray, idf: np.ndarray, other: float, lowest: np.ndarray):
        self.names, self.matrix, self.known, self.idf, self.other, self.lowest = names, matrix, known, idf, other, lowest

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine in [0, 1], and whether the text is rejected."""
        found = frequencies(text) if self.names else None
        if found is None:
            return "und", 0.0, True
        vector, others = placed(*found, self.known)
        vector *= self.idf
        norm = math.sqrt(float(vector @ vector) + others * self.other**2)
        cosines = self.matrix @ vector / (norm or 1.0)
        best = int(cosines.argmax())  # of a tie, the first in order of name
        cosine = min(1.0, max(0.0, float(cosines[best])))
        return self.names[best], cosine, cosine < self.lowest[best, band(len(found[0]))]


def band(n: int) -> int:
    """The length band of a text with ``n`` distinct n-grams."""
    return int(np.searchsorted(EDGES, n, side="right"))


def lowest_cosines(cosines: np.ndarray, of_band: np.ndarray) -> np.ndarray:
    """For each band, the lowest cosine that is accepted, from one language's cosines in the sample; never less for a longer
    band than for a shorter one."""
    out = np.zeros(len(EDGES) + 1)
    for i in range(len(out)):
        own, reach = of_band == i, 0
        near = own
        while near.sum() < FEW and reach < len(EDGES):
            reach += 1
            near = abs(of_band - i) <= reach
        out[i] = np.quantile(cosines[near], LOW)
        if own.any() and own.sum() < FEW:
            out[i] = min(out[i], cosines[own].min())  # too few for a quantile of their own
    return REJECT * np.minimum.accumulate(out[::-1])[::-1]


def spherical_means(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` normalised centroids; starts from the mean and then the row farthest from all starts so far."""
    starts = [rows.sum(axis=0)]
    starts[0] = starts[0] / (np.linalg.norm(starts[0]) or 1.0)
    while len(starts) < min(k, len(rows)):
        starts.append(rows[int((rows @ np.stack(starts).T).max(axis=1).argmin())])
    centres = np.stack(starts)
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.stack([rows[nearest == i].sum(axis=0) for i in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = (sums / np.where(norms == 0, 1, norms))[norms[:, 0] > 0]
    return centres


def fit(docs: DataFrame, size: int = SAMPLE, size_all: int = SAMPLE_ALL) -> Centroids:
    """Centroids from a bounded sample of rows with a language and a letter outside the held-out fold.

    About ``size`` documents of each language are drawn by a hash of their ids, fewer where there are so many languages that
    ``size_all`` would be exceeded. Without any such row there is no language, and every text is ``und``.
    """
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(id_fold("doc_id", 4) != 2)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    each = min(size, size_all / max(1, len(sizes)))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(1 << 20)) / float(1 << 20)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, each / n)).otherwise(share)

    def grams(batches):
        for batch in batches:
            out = [
                (lang, *(a.tobytes() for a in v))
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())
                if (v := frequencies(text)) is not None
            ]
            types = (pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["lang", "grams", "counts"])

    def singles(batches):
        for batch in batches:
            for v in batch.column("grams").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(v, np.uint32).astype(np.int64))], ["gram"])

    sample = known.filter(draw < share).select("lang", whole_text(docs).alias("text"))
    sample = stored(sample.mapInArrow(grams, "lang string, grams binary, counts binary"), "langid-sample")
    texts = sample.mapInArrow(singles, "gram long").groupBy("gram").agg(F.count("*").alias("texts"))
    common = texts.orderBy(F.desc("texts"), "gram").limit(GRAMS).toArrow()  # GRAMS rows at most
    order = np.argsort(common.column("gram").to_numpy())
    known_grams = common.column("gram").to_numpy()[order].astype(np.uint32)

    def vectors(batches):
        for batch in batches:
            out = []
            for g, c in zip(batch.column("grams").to_pylist(), batch.column("counts").to_pylist()):
                vector, others = placed(np.frombuffer(g, np.uint32), np.frombuffer(c, np.float32), known_grams)
                out.append((vector.astype(np.float16).tobytes(), others, len(g) // 4))
            types = (pa.binary(), pa.float64(), pa.int64())
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), *columns], ["lang", "vector", "others", "grams"])

    # Not more than about SAMPLE_ALL rows of GRAMS half-precision numbers.
    table = sample.mapInArrow(vectors, "lang string, vector binary, others double, grams long").toArrow()
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    if not len(langs):
        return Centroids([], np.zeros((0, 0), np.float32), known_grams, np.ones(0, np.float32), 0.0, np.zeros((0, len(EDGES) + 1)))
    rows = np.zeros((len(langs), len(known_grams)), np.float32)
    for i, v in enumerate(table.column("vector")):
        rows[i] = np.frombuffer(v.as_buffer(), np.float16)
    idf = (np.log((1 + len(rows)) / (1 + common.column("texts").to_numpy()[order])) + 0.1).astype(np.float32)
    other = math.log(1 + len(rows)) + 0.1
    rows *= idf
    inside = np.linalg.norm(rows, axis=1)
    rows /= np.where(inside > 0, inside, 1)[:, None]
    half = np.array([zlib.crc32(v.as_buffer()) & 1 for v in table.column("vector")])
    names, centres, cosines = [], [], np.zeros(len(rows), np.float32)
    for name in sorted(set(langs)):
        found = spherical_means(rows[langs == name], CENTROIDS)
        for side in (0, 1):
            own, others = (langs == name) & (half == side), (langs == name) & (half != side)
            if own.any():
                of_others = spherical_means(rows[others], CENTROIDS) if others.any() else found
                cosines[own] = (rows[own] @ of_others.T).max(axis=1)
        names += [name] * len(found)
        centres.append(found)
    matrix = np.concatenate(centres).astype(np.float32)
    whole = np.sqrt(inside**2 + table.column("others").to_numpy() * other**2)
    cosines *= inside / whole
    of_band = np.array([band(n) for n in table.column("grams").to_pylist()])
    lowest = {name: lowest_cosines(cosines[langs == name], of_band[langs == name]) for name in set(names)}
    return Centroids(names, matrix, known_grams, idf, other, np.stack([lowest[n] for n in names]))


def predictor(spark, model: Centroids):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts):
        import pandas as pd

        return pd.DataFrame([shared.value.nearest(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return predict


def identify_language(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine to the nearest centroid) and rejected of every row's whole text.

    Learned from rows with a language whose crc32(doc_id) mod 4 is not 2; ``held_out`` marks the others. NULL texts and texts
    without a letter are ``und`` with score 0, and rejected. NULL ids are predicted and never learned from; repeated rows are
    predicted one by one. Other columns are ignored; an empty table gives no rows.
    """
    predict = predictor(docs.sparkSession, fit(docs, size))
    found = docs.select("doc_id", (id_fold("doc_id", 4) == 2).alias("held_out"), predict(whole_text(docs)).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def drop_unidentified(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, unchanged, that are not rejected."""
    predict = predictor(docs.sparkSession, fit(docs, size))
    return docs.filter(~predict(whole_text(docs))["rejected"])
