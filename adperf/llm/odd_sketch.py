"""Near-duplicate documents by MinHash bands, odd sketches and a check on full shingle sets.

A document's MinHash samples are folded into a parity bitmap: each sample flips one of SKETCH_BITS bits, so samples that two
documents share cancel out and the population count of the bitmaps' XOR tells how many differ. Candidates come from bands
of samples, are thinned by that estimate (far enough below the threshold to lose no link) and confirmed on the full sets.

Equal sets are one class. A band's bucket does not emit all its pairs: its members are compared with two centres, links are
joined into components, and only members outside a bucket's main component are compared with the others, since pairs inside
a component add nothing to it. Before that, shingles that no other such member has are set aside: what is left, counted in
PARTS parts of the hash space, bounds a pair's intersection from above. So every pair that shares a bucket is compared,
already connected or proven to be no link.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import possibly_wanted, stored, whole_text
from adperf.llm.components import connected_components

WORDS = 5  # of a shingle
PERCENT = 85  # least similarity of a link
ROWS, BANDS = 5, 25  # of samples in a band, and least bands: a pair at 0.85 shares no band with probability (1 - 0.85^5)^25 < 1e-6
MISSED = 1e-6  # probability that a pair at the least similarity shares no band; sets the bands below 0.85
SKETCH_BITS = 512
MARGIN = 6.0  # standard deviations that the estimate may lie below the threshold
CHUNK = 4096  # shingles hashed at a time
PARTS = 64  # of the hash space in which shared shingles are counted

_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles. A-Z are lower-cased, words end at ASCII white space; fewer than
    ``width`` words are one shingle, none is an empty set."""
    from xxhash import xxh3_64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes, both concern ASCII alone
    if not found:
        return np.zeros(0, np.uint64)
    word = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(width, len(word))
    rolled = np.full(len(word) - n + 1, n, np.uint64)
    for i in range(n):
        rolled = rolled * _P + word[i : len(word) - n + 1 + i]
    return np.unique(_mixed(rolled))


def band_count(percent: int = PERCENT) -> int:
    """As many bands as a pair at that similarity needs to share one but with probability MISSED."""
    return max(BANDS, math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** ROWS)))) if percent < 100 else BANDS


@functools.cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of ``n`` random linear hash functions."""
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def samples(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Minima of the set under random linear hash functions, ROWS for each band."""
    n = ROWS * band_count(percent)
    factors, offsets = _functions(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK, None] * factors + offsets
        np.minimum(least, part.min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    key = np.arange(len(least) // ROWS, dtype=np.uint64)
    for column in least.reshape(-1, ROWS).T:
        key = _mixed(key * _P + column)
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The samples folded into a parity bitmap of SKETCH_BITS bits, as 64-bit numbers."""
    place = _mixed(least * _P + np.arange(len(least), dtype=np.uint64)) % np.uint64(SKETCH_BITS)
    parity = np.bincount(place.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").view(np.int64)


def largest_xor(percent: int = PERCENT) -> int:
    """The largest population count of an XOR at which a pair of that similarity is still to be expected.

    The count varies with the number of samples that differ (binomial) and with the bits that two of them share; MARGIN
    deviations of both together are allowed.
    """
    n, k, s = SKETCH_BITS, ROWS * band_count(percent), percent / 100
    flips = 2 * k * (1 - s)
    mean = n / 2 * (1 - (1 - 2 / n) ** flips)
    by_bits = n / 4 * (1 + (n - 1) * (1 - 4 / n) ** flips - n * (1 - 2 / n) ** (2 * flips))
    by_samples = k * s * (1 - s) * (2 * (1 - 2 / n) ** flips) ** 2
    return math.ceil(mean + MARGIN * math.sqrt(max(0.0, by_bits) + by_samples))


def sketch_similarity(xor_count: int, percent: int = PERCENT) -> float:
    """The odd sketches' estimate of the similarity."""
    n, k = SKETCH_BITS, ROWS * band_count(percent)
    return 1 + n / (4 * k) * math.log(max(1e-9, 1 - 2 * xor_count / n))


def set_key(found: np.ndarray) -> str:
    return hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest()


def features(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, ``set_key`` (128 bits over the set, NULL of an empty one), bands, sketch."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.string()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                row = (len(found), None, None, None)
                if len(found):
                    least = samples(found, percent)
                    row = (len(found), set_key(found), bands(least), odd_sketch(least))
                for to, value in zip(out, row):
                    to.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(out, list(schema)[1:]))], schema=schema)

    fields = "doc_id long, n_shingles long, set_key string, bands array<long>, sketch array<long>"
    return docs.select(F.col("doc_id").cast("long"), whole_text(docs).alias("text")).mapInArrow(run, fields)


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, set) of the documents named in ``ids`` (id, set_key), from their whole texts. The scan is thinned by a bitmap of the
    ids first, so of the other texts few are shuffled."""

    def run(batches):
        for batch in batches:
            kept, sets = [], []
            for i, key, text in zip(*(batch.column(c).to_pylist() for c in ("id", "set_key", "text"))):
                found = shingles(text)
                if set_key(found) == key:  # rows that share an id may hold other texts
                    kept.append(i)
                    sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text(docs).alias("text"))
    wanted = possibly_wanted(texts, "id", ids).join(ids, "id").select("id", "set_key", "text")
    return wanted.mapInArrow(run, "id long, set array<long>").dropDuplicates(["id"])


def _xor_count(a: str, b: str) -> Column:
    words = SKETCH_BITS // 64
    return sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(words)), F.lit(0))


def _alike(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches that a link can have."""
    sizes = F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent
    return sizes & (_xor_count(a, b) <= largest_xor(percent))


def shared_parts(sets: DataFrame) -> DataFrame:
    """(id, parts): of the sets (id, set), how many of a set's shingles in each part of the hash space another set has too.

    Shingles of one set alone are counted and taken off, so a shingle that very many sets share is grouped (partial counts
    first) and never joined.
    """
    part = F.pmod("shingle", F.lit(PARTS)).cast("int").alias("part")
    alone = sets.select("id", F.explode("set").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("sets"), F.min("id").alias("id"))
    alone = alone.filter("sets = 1").groupBy("id", part).agg(F.count("*").cast("int").alias("n"))
    alone = alone.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("alone"))  # PARTS entries at most

    def run(batches):
        for batch in batches:
            ids, found = batch.column("id"), batch.column("set").to_pylist()
            counts = [np.bincount(np.mod(np.array(s, np.int64), PARTS), minlength=PARTS).astype(np.int32) for s in found]
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.list_(pa.int32()))], ["id", "counts"])

    counts = sets.mapInArrow(run, "id long, counts array<int>").join(alone, "id", "left")
    left = F.transform("counts", lambda n, i: n - F.coalesce(F.try_element_at("alone", i), F.lit(0)))
    return counts.select("id", left.alias("parts"))


def _can_share(a: str, b: str, percent: int) -> Column:
    """Whether the intersection's upper bound allows a link; ``parts`` of both are from one call of shared_parts."""
    most = F.aggregate(F.zip_with(f"{a}.parts", f"{b}.parts", lambda m, n: F.least(m, n)), F.lit(0), lambda total, n: total + n)
    return most * (100 + percent) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * percent


def confirmed(pairs: DataFrame, percent: int, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets (id, set) have the similarity."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    return both.filter(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (doc_id = component_id) of every row.

    Documents are linked when their sets of five-word shingles have at least ``percent`` hundredths of their union in common.
    NULL, empty and white-space texts have an empty set and link with nothing. A row without doc_id links with nothing,
    its component_id is NULL and it is kept. Rows that share a doc_id are one document; if their texts differ, its set is the
    one of them with the smallest digest, and n_shingles is each row's own. Each row is returned. Other columns are
    ignored; an empty table gives no rows.
    """
    found = stored(features(docs, percent), "near-features")
    # A document's set, and classes of equal sets, named by their smallest id: grouped minima, so a class of any size is one row per task.
    keys = found.filter("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("set_key").alias("set_key"))
    keys = stored(keys, "near-keys")
    classes = stored(keys.groupBy("set_key").agg(F.min("doc_id").alias("id")), "near-classes")
    member = found.join(classes.select(F.col("set_key").alias("own_key"), F.col("id")), F.col("doc_id") == F.col("id"))
    member = member.filter("set_key = own_key").dropDuplicates(["id"])
    member = stored(member.select("id", "set_key", F.col("n_shingles").alias("n"), "bands", "sketch"), "near-members")
    bucketed = member.select(F.explode("bands").alias("band"), "id")
    buckets = bucketed.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    buckets = stored(buckets, "near-buckets")
    places = stored(bucketed.join(buckets, "band"), "near-places")  # members of buckets with company
    sketches = member.select("id", "n", "sketch")

    stars = places.select("id", F.explode(F.array("low", "high")).alias("centre")).filter("id <> centre").distinct()
    stars = stars.join(sketches.select("id", F.struct("n", "sketch").alias("x")), "id")
    stars = stars.join(sketches.select(F.col("id").alias("centre"), F.struct("n", "sketch").alias("y")), "centre")
    stars = stars.filter(_alike("x", "y", percent)).select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
    stars = stored(stars.distinct(), "near-stars")
    named_ids = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = stored(member.select("id", "set_key").join(named_ids, "id", "left_semi"), "near-star-ids")
    sets = stored(full_sets(docs, ids), "near-star-sets")
    links = stored(confirmed(stars, percent, sets), "near-links")
    component = stored(connected_components(links, "near-components"), "near-component")

    # Members that their bucket's main component does not hold, against all others of the bucket.
    named = places.select("band", "id").join(component.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.select("band", "id", F.coalesce("component", "id").alias("component")), "near-named")
    parts = named.groupBy("band", "component").agg(F.count("*").alias("size"))
    main = parts.groupBy("band").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("kinds"))
    named = named.join(main.filter("kinds > 1").select("band", "main"), "band")
    named = stored(named, "near-open")
    ids = stored(member.select("id", "set_key").join(named.select("id").distinct(), "id", "left_semi"), "near-open-ids")
    sets = stored(full_sets(docs, ids), "near-open-sets")
    bounds = shared_parts(sets).withColumn("most", F.aggregate("parts", F.lit(0), lambda total, n: total + n))
    # A member that shares too little with all others together links with none of them.
    able = sketches.join(bounds, "id").filter(F.col("most") * 100 >= F.col("n") * percent)
    named = stored(named.join(able, "id"), "near-able")
    x, y = (F.struct("id", "component", "main", "n", "sketch", "parts").alias(side) for side in "xy")
    strays = named.filter("component <> main").select("band", x)
    other = named.select(F.col("band").alias("other_band"), y)
    new = (F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    apart = (F.col("x.component") != F.col("y.component")) & new & _alike("x", "y", percent) & _can_share("x", "y", percent)
    rest = strays.join(other, (F.col("band") == F.col("other_band")) & apart)
    rest = rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    rest = stored(confirmed(stored(rest.distinct(), "near-rest"), percent, sets), "near-rest-links")
    if not rest.isEmpty():
        merged = component.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest)
        component = stored(connected_components(merged, "near-components"), "near-component")

    # Back to all documents: a class's component, else the class itself.
    of_class = classes.join(component.withColumnRenamed("node", "id"), "id", "left")
    of_class = of_class.select(F.col("set_key"), F.coalesce("component", "id").alias("class_component"))
    of_document = keys.join(of_class, "set_key").select("doc_id", "class_component")
    out = found.select("doc_id", "n_shingles").join(of_document, "doc_id", "left")
    component_id = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("class_component", "doc_id"))
    out = out.select("doc_id", "n_shingles", component_id.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, unchanged, but one document of each group; of rows that share a doc_id, one."""
    found = stored(near_duplicates(docs, percent), "near-result")
    dropped = found.filter("NOT kept").select(F.col("doc_id").alias("__near_id")).distinct()
    kept = docs.join(dropped, F.col("doc_id") == F.col("__near_id"), "left_anti")
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("__near_id")), "near-repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col("doc_id") == F.col("__near_id"), "left_anti")
    again = kept.join(repeated, F.col("doc_id") == F.col("__near_id"), "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(again)
