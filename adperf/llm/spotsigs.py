"""SpotSigs fingerprints, in DataFrame functions only.

Each occurrence of an anchor (a common word) forms a signature of itself and the next CHAIN content words, which are all
words but anchors. A text's fingerprint is the sorted set of its signatures' 32-bit hashes. Boilerplate has few common
words, so fingerprints follow running text. Sets are compared by Jaccard likeness; a pair whose lengths alone keep it below
the threshold is never compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adperf.llm.common import stored, whole_text

# Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to a in is that for on as with was at by it from or an be are this "
    "le la les de des du un une et en que qui dans pour sur avec par est au "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch "
    "el los las del y por con para su se al es lo"
).split()
CHAIN = 2
BITS = 13  # of an id that one level of the ring resolves: no window holds more than 2^13 rows


def _any_of(words) -> str:
    """A pattern for any of the words, with shared beginnings tried once."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    return "|".join(h + (f"(?:{_any_of(rest)})" if rest != [""] else "") if h else "" for h, rest in sorted(heads.items(), reverse=True))


def signatures(text: Column) -> Column:
    """The sorted distinct signature hashes of a text.

    Each anchor is first glued to the word behind it, so that one split gives content words with the anchors before
    them. A text without an anchor takes every word as an anchor, one without a word its whole characters; an empty
    text has no signature.
    """
    # a-z and 0-9 are letters and digits too: named first, most characters need no look at their category
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9\p{L}\p{N}]+", " "))
    glue = f"(?<![^ ])({_any_of(ANCHORS)}) "

    def once(value: Column, of) -> Column:
        # a lambda variable is evaluated once
        return F.transform(F.array(value), of)[0]

    def expanded(chain: Column) -> Column:
        return once(F.split(chain, "_"), lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), lambda a: F.hash(a, F.element_at(p, -1))))

    def chained(words: Column) -> Column:
        following = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
        content = lambda w: F.coalesce(F.substring_index(w, "_", -1), F.lit(""))
        anchored = lambda w: F.contains(w, F.lit("_"))
        chains = F.zip_with(words, following, lambda a, b: F.when(anchored(a), F.concat(a, F.lit(" "), content(b))))
        every = F.zip_with(words, following, lambda a, b: F.hash(F.concat(a, F.lit(" "), content(b))))
        return F.when(F.exists(words, anchored), F.flatten(F.transform(F.filter(chains, lambda s: s.isNotNull()), expanded))).otherwise(every)

    def of_plain(p: Column) -> Column:
        found = once(F.split(F.regexp_replace(p, glue, "$1_"), " "), chained)
        return F.when(p == "", F.array(F.hash(text))).otherwise(F.array_sort(F.array_distinct(found)))

    return F.when(text == "", F.array().cast("array<int>")).otherwise(once(plain, of_plain))


def printed(found: Column) -> Column:
    """A fingerprint as text: its numbers, separated by spaces."""
    return F.array_join(found.cast("array<string>"), " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two fingerprints, 1 for two empty ones; 0 without a comparison where the set lengths keep it
    below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    # one-element array: the intersection is made once
    compared = F.transform(F.array(common), lambda c: c / (F.size(a) + F.size(b) - c))[0]
    return F.when(large == 0, 1.0).when((small == 0) | (small < large * least), 0.0).otherwise(compared)


def ring(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) for distinct ids: the next smaller id, and the largest for the smallest.

    Level by level, ids are grouped by their higher bits; inside a group each finds the next smaller member, and
    the group's ends go to the next level. A window holds at most 2^BITS rows whatever the ids are.
    """
    level = stored(ids.select(F.col("doc_id").alias("g"), F.col("doc_id").alias("low"), F.col("doc_id").alias("high")), "ring")
    pairs, width = None, 0
    while True:
        width += BITS
        parent = F.shiftright("g", BITS) if width < 64 + BITS else F.lit(0).cast("long")
        level = level.withColumn("parent", parent)
        found = level.select("low", F.lead("high").over(Window.partitionBy("parent").orderBy(F.desc("g"))).alias("next_id"))
        found = found.filter("next_id IS NOT NULL").select(F.col("low").alias("doc_id"), "next_id")
        pairs = found if pairs is None else pairs.unionByName(found)
        level = stored(level.groupBy(F.col("parent").alias("g")).agg(F.min("low").alias("low"), F.max("high").alias("high")), "ring")
        if level.count() <= 1:
            return pairs.unionByName(level.select(F.col("low").alias("doc_id"), F.col("high").alias("next_id")))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's whole text and of its edited text, with their likeness.

    The edited text has the last third of the code points (rounded down) replaced by as many first ones of the next
    document (or all of them), in descending order of doc_id; the first follows the last. Returned: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    NULL texts are empty. A row without doc_id has no next document: its edited text lacks the last third and near_next is
    0. Of rows that share a doc_id the smallest text is the next one of the document before; each row is
    returned. Other columns are ignored; an empty table gives no rows.

    A text crosses the network once by its own id, and its beginning and fingerprint once more to the document before it.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    own = docs.select(doc_id, whole_text(docs).alias("text"))
    sizes = own.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("n_rows"), F.max(F.floor(F.char_length("text") / 3)).alias("third")
    )
    sizes = stored(sizes, "spot-sizes")
    repeated = not sizes.filter("n_rows > 1").isEmpty()
    # For each next document: the one before it, and how much of its text that one needs.
    before = ring(sizes.select("doc_id")).join(sizes.select("doc_id", "third"), "doc_id")
    before = before.select(F.col("doc_id").alias("target"), F.col("next_id"), F.col("third").cast("int").alias("third"))
    dealt = own.filter("doc_id IS NOT NULL").repartition(parts, "doc_id")
    giving = dealt.join(before, F.col("doc_id") == F.col("next_id"))
    if repeated:
        smallest = Window.partitionBy("doc_id").orderBy("text")
        giving = giving.withColumn("rank", F.row_number().over(smallest)).filter("rank = 1")
    giving = giving.select("target", F.expr("substring(text, 1, third)").alias("beginning"), signatures(F.col("text")).alias("next_signs"))
    joined = dealt.join(giving, F.col("doc_id") == F.col("target")).drop("target")
    without = docs.filter("doc_id IS NULL").select(
        F.lit(None).cast("long").alias("doc_id"), whole_text(docs).alias("text"), F.lit("").alias("beginning"),
        F.array(F.lit(None).cast("int")).alias("next_signs"),
    )
    rows = joined.unionByName(without).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(
        F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 3) as int))"),
        F.expr("substring(beginning, 1, cast(floor(n_chars / 3) as int))"),  # sent for the longest row of the id
    )
    rows = rows.withColumn("edited", edited).withColumns({"signs": signatures(F.col("text")), "edited_signs": signatures(F.col("edited"))})
    near_next = F.when(F.col("doc_id").isNull(), 0.0).otherwise(likeness(F.col("signs"), F.col("next_signs")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("signs")).alias("fingerprint"),
        printed(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"), near_next.alias("near_next"),
    )


def near_pairs(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of classes of equal fingerprints with at least that likeness, and membership (doc_id, class).

    Classes are named by their smallest doc_id. Sets are partitioned by length so that only sets of one or of
    neighbouring partitions can be alike; inside these, two sets are compared only if they share one of their rarest
    signatures, as many as a pair above the threshold cannot avoid sharing, and so early in both that enough can follow.
    Signatures of one set only are the rarest and lead to no pair: they take their places but are not kept. Empty texts and
    NULL ids are left out. Of rows that share an id the one whose fingerprint has the smallest digest counts.
    """
    text = whole_text(docs)
    # Only an empty text has no signature. A condition on the signatures would be pushed down and compute them twice.
    found = docs.filter(F.col("doc_id").isNotNull() & (text != "")).select(F.col("doc_id").cast("long"), signatures(text).alias("signs"))
    found = stored(found.withColumn("key", F.sha2(printed(F.col("signs")), 256)), "spot-found")
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n_rows"), F.min("key").alias("first")).filter("n_rows > 1")
    repeated = stored(repeated, "spot-repeated")
    if not repeated.isEmpty():
        found = found.join(repeated, "doc_id", "left").filter("n_rows IS NULL OR key = first").select("doc_id", "signs", "key")
        found = stored(found.dropDuplicates(["doc_id"]), "spot-first")
    classes = stored(found.groupBy("key").agg(F.min("doc_id").alias("class")), "spot-classes")
    members = found.select("doc_id", "key").join(classes, "key").select("doc_id", "class")
    one = found.join(classes, found["doc_id"] == classes["class"], "left_semi").select(F.col("doc_id").alias("class"), "signs")
    one = stored(one, "spot-sets")
    each = one.select("class", F.size("signs").alias("n"), F.explode("signs").alias("sign"))
    rarity = each.groupBy("sign").agg(F.count("*").alias("rarity")).filter("rarity > 1")
    # A set's group is as large as the set itself.
    ranked = each.join(rarity, "sign").groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("rarity", "sign"))).alias("ranked"))
    alone = F.col("n") - F.size("ranked")  # signatures of this set only
    shared = F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1
    length = F.floor(F.log(F.col("n")) / math.log(1 / least) + 1e-9).cast("int")
    index = ranked.select("class", "n", length.alias("length"), alone.alias("alone"), F.posexplode(F.slice("ranked", F.lit(1), F.greatest(shared - alone, F.lit(0)))))
    # rest: signatures from this one on, in the order of all sets
    index = index.select("class", "n", "length", (F.col("n") - F.col("alone") - F.col("pos")).alias("rest"), F.col("col.sign").alias("sign"))
    index = stored(index, "spot-index")
    # The shorter set (of equal lengths, the smaller name) looks into its own partition and the next.
    left = index.select(
        F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"), "sign", F.explode(F.array("length", F.col("length") + 1)).alias("length")
    )
    right = index.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"), "sign", "length")
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    # From the first signature that a pair shares, both sets have all that they share.
    enough = F.least("rest_a", "rest_b") * (1 + least) >= (F.col("n_a") + F.col("n_b")) * least - 1e-6
    pairs = left.join(right, ["sign", "length"]).filter(ordered & (F.col("n_a") >= F.col("n_b") * least) & enough).select("a", "b").distinct()
    pairs = pairs.join(one.select(F.col("class").alias("a"), F.col("signs").alias("x")), "a").join(one.select(F.col("class").alias("b"), F.col("signs").alias("y")), "b")
    compared = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness(F.col("x"), F.col("y"), least).alias("likeness"))
    # filtered inside an array: a condition pushed down would compare each pair twice
    return pairs.select(F.inline(F.filter(F.array(compared), lambda p: p["likeness"] >= least))), members


def near_documents(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """One row per doc_id: ``class`` (the smallest id of an equal fingerprint), ``n_links`` (classes of other fingerprints with at
    least that likeness), ``nearest`` (the likest of these, the smallest of equally like ones) and ``likeness`` to it.

    Pairs are found by ``near_pairs``: between classes, so copies are not expanded. An empty or NULL text is a class of its
    own without links; rows without doc_id are left out; an empty table gives no rows, other columns are ignored.
    """
    pairs, members = near_pairs(docs, least)
    # each pair twice, from one comparison
    both = pairs.select(F.inline(F.array(*(F.struct(F.col(x).alias("class"), F.col(y).alias("other"), "likeness") for x, y in ("ab", "ba")))))
    links = both.groupBy("class").agg(F.count("*").alias("n_links"), F.max(F.struct("likeness", (-F.col("other")).alias("other"))).alias("best"))
    empty = docs.filter(F.col("doc_id").isNotNull()).filter(whole_text(docs) == "").select(F.col("doc_id").cast("long").alias("doc_id"))
    without = empty.distinct().join(members, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("class"))
    found = members.unionByName(without).join(links, "class", "left")
    return found.select(
        "doc_id", "class", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (-F.col("best.other")).alias("nearest"), F.col("best.likeness").alias("likeness"),
    )
