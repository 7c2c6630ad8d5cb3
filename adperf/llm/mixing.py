"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored

# Means above this are drawn as a sum of independent Poisson variables of smaller mean.
PART_MEAN = 16.0
# Terms of a part's distribution; beyond them its tail is below the resolution of the uniform numbers.
TERMS = 80
BLOCK = 4096
# Source tables up to this many rows are broadcast (80 doubles a row); larger ones are joined by source and salt.
BROADCAST_SOURCES = 2_000
SALTS = 64
ADDED = ("mix_rate", "mix_part", "mix_copy", "mix_key")


def _uniform(*parts: Column) -> Column:
    """52 bits of md5 over the parts, in [0, 1)."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict, default: float, total: int | None = None) -> DataFrame:
    """One row for each source: n documents, and ``rate``, the mean number of copies that brings the source to its share
    of ``total`` documents (as many as there are if not given). A source not named has weight ``default``."""
    weight = F.lit(float(default))
    for name, value in weights.items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = stored(docs.groupBy("source").agg(F.count("*").alias("n")).withColumn("weight", weight), "mixing-sources")
    whole = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("n").alias("all_n"))  # one row
    target = F.col("all_n") if total is None else F.lit(total)
    return sizes.crossJoin(F.broadcast(whole)).select(
        "source", "n", F.coalesce(F.col("weight") / F.col("all_weight") * target / F.col("n"), F.lit(0.0)).alias("rate")
    )


def _renamed(docs: DataFrame) -> DataFrame:
    """Columns whose names could be those of a step get names that are not."""
    return docs.toDF(*(f"__kept_{i}" if c.lower().startswith("__") else c for i, c in enumerate(docs.columns)))


def mix(docs: DataFrame, weights: dict, default: float = 1.0, seed: int = 11, total: int | None = None) -> DataFrame:
    """Every row of ``docs`` as often as a Poisson variable of its source's rate says, in a global pseudo-random order.

    The variable inverts the Poisson distribution at hash numbers of (seed, doc_id, part), so a rerun draws the same; a mean
    above PART_MEAN is the sum of equal parts. Added columns: ``mix_rate``, ``mix_part`` and ``mix_copy`` (from 1 in its part;
    together they number a document's copies) and ``mix_key``, by which rows are dealt to partitions and sorted inside
    them: that is the shuffled order.

    NULL sources form one source. A row without doc_id draws by its text. Repeated rows draw the same number. A weight of 0
    removes a source. An empty table gives no rows. Input columns pass unchanged, whatever their names, but for those four,
    which are drawn anew: a mixed table can be mixed again.

    Only the per-source counts are grouped (partial counts first). The copies of a hot source are dealt by hash like all
    others. The source table is broadcast up to BROADCAST_SOURCES rows, beyond that joined with salt.
    """
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    names, docs = docs.columns, _renamed(docs)
    table = rates(docs, weights, default, total).withColumn("parts", F.ceil(F.col("rate") / PART_MEAN).cast("long"))
    table = table.filter("parts > 0").withColumn("mean", F.col("rate") / F.col("parts"))
    step = lambda acc, k: F.struct(
        (acc["p"] * F.col("mean") / k).alias("p"),
        (acc["c"] + acc["p"] * F.col("mean") / k).alias("c"),
        F.concat(acc["cdf"], F.array(acc["c"] + acc["p"] * F.col("mean") / k)).alias("cdf"),
    )
    none = F.exp(-F.col("mean"))
    first = F.struct(none.alias("p"), none.alias("c"), F.array(none).alias("cdf"))
    ks = F.sequence(F.lit(1), F.lit(TERMS)).cast("array<double>")
    table = table.select(
        F.col("source").alias("__mix_source"), F.col("rate").alias("mix_rate"), F.col("parts").alias("__mix_parts"),
        F.aggregate(ks, first, step)["cdf"].alias("__mix_cdf"),
    )
    table = stored(table, "mixing-rates")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    same = F.col("source").eqNullSafe(F.col("__mix_source"))
    if table.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(table), same)
    else:
        salted = table.withColumn("__mix_table_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(identity), F.lit(SALTS)).cast("int")
        joined = docs.withColumn("__mix_salt", salt).join(salted, same & (F.col("__mix_salt") == F.col("__mix_table_salt")))
    # Parts in two steps, so that no array holds more than the root of their number.
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("__mix_parts") - 1) / BLOCK)))
    last = F.least(F.col("__mix_parts"), (F.col("__mix_block") + 1) * BLOCK) - 1
    inside = F.explode(F.sequence(F.col("__mix_block") * BLOCK, last))
    drawn = joined.withColumn("__mix_block", block).withColumn("mix_part", inside)
    drawn = drawn.withColumn("__mix_u", F.array(_uniform(F.lit(str(seed)), identity, F.col("mix_part"))))
    below = lambda u: F.size(F.filter("__mix_cdf", lambda c: c <= u))
    drawn = drawn.withColumn("__mix_count", F.transform("__mix_u", below)[0]).filter("__mix_count > 0")
    copies = drawn.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_count"))))
    copies = copies.withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(f"{seed} order"), identity, "mix_part", "mix_copy").cast("binary")))
    copies = copies.select(*(F.col(f"`{c}`").alias(name) for c, name in zip(docs.columns, names)), *ADDED)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(shuffled, "mix_key").sortWithinPartitions("mix_key")


# Production weights of the test corpus: the large source is held to four parts against one of each other source.
WEIGHTS = {"src0": 4.0}

SQL = f"""
WITH sizes AS (SELECT source, count(*) AS n, CASE WHEN source = 'src0' THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM documents GROUP BY source),
rates AS (SELECT source, w / (SELECT sum(w) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS rate FROM sizes),
parts AS (SELECT source, rate, ceil(rate / {PART_MEAN})::BIGINT AS parts FROM rates),
terms AS (SELECT source, k, exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) AS p FROM parts, range(0, {TERMS + 1}) t(k)),
cdf AS (SELECT source, list(c ORDER BY k) AS cdf
        FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
drawn AS (SELECT d.*, rate, part,
                 ('0x' || substr(md5('11|' || doc_id || '|' || part), 1, 13))::BIGINT / {1 << 52}.0::DOUBLE AS u
          FROM documents d JOIN parts USING (source), range(0, parts.parts) r(part)),
counted AS (SELECT drawn.*, len(list_filter(cdf, lambda c: c <= u)) AS copies FROM drawn JOIN cdf USING (source))
SELECT doc_id, text, lang, source, n_chars, rate AS mix_rate, part::BIGINT AS mix_part, mix_copy::INT AS mix_copy,
       md5('11 order|' || doc_id || '|' || part || '|' || mix_copy) AS mix_key
FROM counted, range(1, copies + 1) c(mix_copy)"""
