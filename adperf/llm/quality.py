"""Quality rules by a ledger of failure bits.

Every document is measured once and every rule evaluated once: the ledger holds the measurements and one number whose bit i says that
rule i fails. A policy is a version and the bits of the rules it applies, so a document's verdict under any version, and
what each rule adds to it, are bitwise operations on the ledger; texts are not read again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import whole_text

WINDOW = 8  # words whose repetition counts
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bullets", "n_ellipses", "n_digits")

# A rule's place is its bit: new rules go to the end, so that ledgers already written stay readable. All are in whole numbers.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("bullets", "100 * n_bullets > 90 * n_lines"),
    ("ellipses", "100 * n_ellipses > 30 * n_lines"),
    ("digits", "100 * n_digits > 30 * word_chars"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
]
BASE = ("few_words", "repeated_windows")
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines"),
    3: tuple(name for name, _ in RULES),
}
VERSION = 3


def mask(rules) -> int:
    """The bits of the rules named."""
    names = [name for name, _ in RULES]
    return sum(1 << names.index(name) for name in set(rules))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a stretch of ``window`` words (a power of two) which the text holds twice or more.

    Stretches of 2, 4, 8 words are numbered by the pair of their halves' numbers, so equal numbers are equal words.
    """
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    rank, width = np.array([number.setdefault(w, len(number)) for w in words], np.int64), 1
    while width < window:
        kinds, rank = np.unique(rank[:-width] * len(words) + rank[width:], return_inverse=True)
        if len(kinds) == len(rank):
            return 0
        width *= 2
    again = np.bincount(rank)[rank] > 1
    change = np.zeros(len(words) + 1, np.int64)
    change[: len(again)] += again
    change[window : window + len(again)] -= again
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def measures(text: bytes) -> tuple[int, ...]:
    """The MEASURES of an UTF-8 text."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(count[0x80:0xC0].sum()) - int(count[list(BLANK)].sum())  # a code point has one byte outside 80-BF
    words = text.split()  # bytes end words at ASCII white space
    lines = [line for line in text.split(b"\n") if line.strip()]
    bullets = sum(line.lstrip().startswith((b"-", b"*", "•".encode())) for line in lines)
    ellipses = sum(line.rstrip().endswith((b"...", "…".encode())) for line in lines)
    symbols, digits = int(count[list(SYMBOLS)].sum()), int(count[0x30:0x3A].sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), bullets, ellipses, digits


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the MEASURES and ``failed``, the bits of the RULES that fail, of every row.

    Words are stretches without ASCII white space, lines end at line feeds and count if they hold a word. NULL, empty and
    white-space texts measure 0 everywhere and fail ``few_words``. Each row counts for itself, so repeated and NULL ids are rows like
    others; other columns are ignored; an empty table gives an empty ledger. A task holds one batch of texts.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((name, pa.int64()) for name in MEASURES)])

    def run(batches):
        for batch in batches:
            rows = [measures(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            columns = np.array(rows, np.int64).reshape(-1, len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in columns)], schema=schema)

    fields = ", ".join(f"{f.name} long" for f in schema)
    measured = docs.select(F.col("doc_id").cast("long"), whole_text(docs).alias("text")).mapInArrow(run, fields)
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def judge(rows: DataFrame, version: int = VERSION) -> DataFrame:
    """A ledger with ``base_failed``, ``kept`` under the policy of that version, and ``sole``: the one rule's bit that
    alone rejects a document (dropping the rule would keep it), else 0."""
    bits = F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version])))
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    sole = F.when(F.bit_count(bits) == 1, bits).otherwise(F.lit(0)).cast("long")
    return rows.withColumns({"base_failed": base, "kept": ~base & (bits == 0), "sole": sole})


def ablations(rows: DataFrame) -> DataFrame:
    """For every policy and each of its rules: version, rule, documents, kept, n_failed, kept_without, with_any, with_all.

    ``kept_without`` is what the policy would keep without the rule; ``with_any`` and ``with_all`` are the bits of the policy's rules that
    fail on some, and on all, of the documents that the rule rejects (0 if it rejects none). Equal ledger numbers are counted
    first, so what is aggregated has at most 2 to the power of the number of rules rows.
    """
    counted = rows.groupBy("failed").agg(F.count("*").alias("n"))
    entries = [
        F.struct(F.lit(version).alias("version"), F.lit(name).alias("rule"), F.lit(mask([name])).cast("long").alias("bit"), F.lit(mask(names)).cast("long").alias("mask"))
        for version, names in POLICIES.items()
        for name in names
    ]
    each = counted.select("n", "failed", F.explode(F.array(*entries)).alias("p")).select("n", "failed", "p.*")
    each = each.withColumn("bits", F.col("failed").bitwiseAND(F.col("mask")))
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return each.groupBy("version", "rule").agg(
        F.sum("n").alias("documents"), total(F.col("bits") == 0).alias("kept"), total(hit).alias("n_failed"),
        total((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("kept_without"),
        F.coalesce(F.bit_or(F.when(hit, F.col("bits"))), F.lit(0)).cast("long").alias("with_any"),
        F.coalesce(F.bit_and(F.when(hit, F.col("bits"))), F.lit(0)).cast("long").alias("with_all"),
    )


def _ledger_sql() -> str:
    failed = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(RULES))
    return rf"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS solid FROM texts),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
wide AS (SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS shingle FROM words),
found AS (SELECT r, i, len(shingle) = {WINDOW} AND COUNT(*) OVER (PARTITION BY r, shingle) > 1 AS again FROM wide),
covered AS (SELECT r, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS c FROM found),
repeats AS (SELECT r, COUNT(*) AS n_repeat_words FROM covered WHERE c GROUP BY r),
lines AS (SELECT r, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines,
    COUNT(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09-\x0D]*[-*•]')) AS n_bullets,
    COUNT(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS n_ellipses
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(solid) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(solid, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, COALESCE(n_dup_lines, 0) AS n_dup_lines,
    COALESCE(n_repeat_words, 0) AS n_repeat_words, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_bullets, 0) AS n_bullets, COALESCE(n_ellipses, 0) AS n_ellipses,
    CAST(length(regexp_replace(solid, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits
    FROM split LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
ledger AS (SELECT *, CAST({failed} AS BIGINT) AS failed FROM measured)
"""


SQL = _ledger_sql() + (
    f"SELECT *, (failed & {mask(BASE)}) <> 0 AS base_failed, (failed & {mask((*BASE, *POLICIES[VERSION]))}) = 0 AS kept, "
    f"CAST(CASE WHEN bit_count(failed & {mask(POLICIES[VERSION])}) = 1 THEN failed & {mask(POLICIES[VERSION])} ELSE 0 END AS BIGINT) AS sole FROM ledger"
)
ABLATION_SQL = _ledger_sql() + (
    "SELECT version, rule, COUNT(*) AS documents, COUNT(*) FILTER (WHERE failed & mask = 0) AS kept, COUNT(*) FILTER (WHERE failed & bit <> 0) AS n_failed, "
    "COUNT(*) FILTER (WHERE failed & (mask - bit) = 0) AS kept_without, "
    "COALESCE(bit_or(failed & mask) FILTER (WHERE failed & bit <> 0), 0) AS with_any, COALESCE(bit_and(failed & mask) FILTER (WHERE failed & bit <> 0), 0) AS with_all "
    "FROM ledger, (VALUES "
    + ", ".join(f"({v}, '{name}', {mask([name])}::BIGINT, {mask(names)}::BIGINT)" for v, names in POLICIES.items() for name in names)
    + ") AS p(version, rule, bit, mask) GROUP BY version, rule"
)
