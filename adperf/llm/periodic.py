"""Periodic runs of words by recompression.

A task joins the words of its documents, with a separator between any two that occurs once, and compresses the sequence level by
level: maximal blocks of one symbol become one symbol each (a symbol and its count: run-length rules), then pairs of a left and a right symbol
become one each, where a hash of the symbol says which side it is on. Both choices depend on the symbols alone, so
equal stretches are compressed alike but for their ends, and the longest common extension of two places takes a few steps on
each of the O(log n) levels: up while the symbols agree, down again into the first two that differ.

A run of period q and length L holds L - q places whose words equal those q further on. Places on a grid of that width meet
every run, one grid for each q: n / q places, harmonic in total. Where such a place and its neighbours agree with those q
further on, two extension queries give the run's exact ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import whole_text

LEAST, EXPONENT = 6, 4  # a run has at least so many words and so many periods
CHUNK = 200_000  # words compressed together; a longer document is compressed by itself
QUERIES = 200_000  # extension queries asked together

_P = np.uint64(0x9E3779B97F4A7C15)


class Level:
    """One level's symbols, read in one direction: the symbol that each of them goes into, and that one's first symbol here."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, blocks: bool):
        self.symbols, self.blocks = symbols, blocks
        self.starts = np.append(starts, len(symbols)).astype(np.int32)  # and the end
        self.parent = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(self.starts))
        self.first = np.zeros(len(symbols), bool)
        self.first[starts] = True

    def reversed(self) -> "Level":
        return Level(self.symbols[::-1], len(self.symbols) - self.starts[:0:-1], self.blocks)

    def step(self, at: np.ndarray, to: np.ndarray) -> np.ndarray | int:
        """How far places of equal symbols may go on at once: to the end of the shorter of two blocks."""
        if not self.blocks:
            return 1
        return np.minimum(self.starts[self.parent[at] + 1] - at, self.starts[self.parent[to] + 1] - to)


class Grammar:
    """The levels of a sequence of numbers from 0 on, compressed until no symbol occurs twice."""

    def __init__(self, sequence: np.ndarray):
        symbols, self.levels = sequence.astype(np.int32), []
        made, turn = (int(symbols.max()) + 1 if len(symbols) else 0), 0
        while len(symbols) > 1:
            starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
            if len(starts) < len(symbols):
                counts = np.diff(np.append(starts, len(symbols)))
                new, many = symbols[starts], counts > 1
                rules, rule = np.unique(new[many] * np.int64(len(symbols) + 1) + counts[many], return_inverse=True)
                new[many] = made + rule
                made += len(rules)
                self.levels.append(Level(symbols, starts, True))
                symbols = new
            if np.bincount(symbols, minlength=1).max() == 1:
                break
            joined = self._pairs(symbols, turn)
            turn += 1
            if not len(joined):
                continue
            keep = np.ones(len(symbols), bool)
            keep[joined + 1] = False
            starts = np.flatnonzero(keep)
            rules, rule = np.unique(symbols[joined] * np.int64(made) + symbols[joined + 1], return_inverse=True)
            new = symbols.copy()
            new[joined] = made + rule
            made += len(rules)
            self.levels.append(Level(symbols, starts, False))
            symbols = new[starts]
        self.top = symbols

    @staticmethod
    def _pairs(symbols: np.ndarray, turn: int) -> np.ndarray:
        """Places of symbols of one side before one of the other; of the two ways round, the one with more of them."""
        mixed = (symbols.astype(np.uint64) + np.uint64(turn + 1)) * _P
        side = ((mixed ^ (mixed >> np.uint64(31))) * _P >> np.uint64(63)).astype(bool)
        ways = [np.flatnonzero(a[:-1] & b[1:]) for a, b in ((side, ~side), (~side, side))]
        return max(ways, key=len)

    def reversed(self) -> "Grammar":
        """The same grammar read from the end."""
        other = object.__new__(Grammar)
        other.levels, other.top = [level.reversed() for level in self.levels], self.top[::-1]
        return other

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions of the places ``a`` < ``b``. The sequence ends in a number that occurs once."""
        u, v = a.astype(np.int64), b.astype(np.int64)
        left: list[np.ndarray] = []  # by level, the queries whose symbols there differ
        going = np.arange(len(u))
        for level in self.levels:
            differing = []
            inside = going[~(level.first[u[going]] & level.first[v[going]])]
            while len(inside):
                equal = level.symbols[u[inside]] == level.symbols[v[inside]]
                differing.append(inside[~equal])
                inside = inside[equal]
                step = level.step(u[inside], v[inside])
                u[inside] += step
                v[inside] += step
                inside = inside[~(level.first[u[inside]] & level.first[v[inside]])]
            left.append(np.concatenate(differing) if differing else going[:0])
            if len(left[-1]):
                stopped = np.zeros(len(u), bool)
                stopped[left[-1]] = True
                going = going[~stopped[going]]
            u[going], v[going] = level.parent[u[going]], level.parent[v[going]]
        # No symbol of the top occurs twice: all queries differ there, and go down to the words that differ.
        for level, more in zip(reversed(self.levels), reversed(left)):
            u[going], v[going] = level.starts[u[going]], level.starts[v[going]]
            equal = going[level.symbols[u[going]] == level.symbols[v[going]]]
            while len(equal):
                step = level.step(u[equal], v[equal])
                u[equal] += step
                v[equal] += step
                equal = equal[level.symbols[u[equal]] == level.symbols[v[equal]]]
            going = np.concatenate([going, more])
        return u - a


def runs(sequence: np.ndarray, lengths: list[int], least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of all documents, by start and period, starts counted in ``sequence``.

    ``sequence`` holds a number that occurs once, then every document's words as numbers, followed each by a number that occurs
    once; ``lengths`` are the documents' word counts, falling. A run has its smallest period q, at least ``least`` words
    and at least ``exponent`` (2 or more) periods, and no neighbouring word extends it keeping the period.
    """
    grammar = backward = None
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ends = np.cumsum(np.array([0, *lengths], np.int64) + 1)  # of documents that are the longest ones, the separator included
    cover = np.full(len(sequence), -1, np.int64)  # a known run over a place: the row in `known`
    known = np.zeros((0, 2), np.int64)  # end, period
    waiting: list[tuple[np.ndarray, int]] = []
    queries, none, padded = 0, np.zeros(0, np.int64), np.append(sequence, -1)

    def ask():
        nonlocal grammar, backward, known, queries
        at = np.concatenate([none, *(w for w, _ in waiting)])
        period = np.concatenate([none, *(np.full(len(w), q, np.int64) for w, q in waiting)])
        waiting.clear()
        queries = 0
        if not len(at):
            return
        if grammar is None:
            grammar = Grammar(sequence)
            backward = grammar.reversed()
        after = grammar.extensions(at, at + period)
        last = len(sequence) - 1
        before = backward.extensions(last - (at + period), last - at)  # this place included
        start, length = at - before + 1, after + before - 1 + period
        good = length >= np.maximum(least, exponent * period)
        start, length, period = _distinct(start[good], length[good], period[good])
        found.append((start, length, period))
        # Longer runs than twice the exponent are found again at multiples of their periods; known, they spare those queries.
        long = np.flatnonzero(length >= 2 * exponent * period)
        for row, s, n in zip(range(len(known), len(known) + len(long)), start[long].tolist(), length[long].tolist()):
            cover[s : s + n] = row
        known = np.concatenate([known, np.stack([start[long] + length[long], period[long]], axis=1)])

    q = 1
    while lengths and lengths[0] >= max(least, exponent * q):
        shortest = max(least, exponent * q)
        count = np.searchsorted(-np.asarray(lengths), -shortest, side="right")
        end = int(ends[count]) - 1
        width = shortest - q
        at = np.flatnonzero(sequence[1 : end - q : width] == sequence[1 + q : end : width]) * width + 1
        if len(at):
            at = at[_agrees(padded, at, q)]
            if len(at) and len(known):
                run = cover[at]
                inside = run >= 0
                inside[inside] = (at[inside] + q < known[run[inside], 0]) & (q % known[run[inside], 1] == 0)
                at = at[~inside]
            if len(at):
                waiting.append((at, q))
                queries += len(at)
                if queries >= QUERIES:
                    ask()
        q += 1
    ask()
    start, length, period = _distinct(*(np.concatenate(c) for c in zip(*found))) if found else (none, none, none)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _distinct(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal stretches are one run, with the smallest of their periods."""
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    again = np.zeros(len(start), bool)
    again[1:] = (start[1:] == start[:-1]) & (length[1:] == length[:-1])
    return start[~again], length[~again], period[~again]


def _agrees(padded: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """Whether three places on end, the one at ``at`` among them, equal those q further on; a run holds more than that."""
    b, c, d, e = (padded[at + k] == padded[at + k + q] for k in (-2, -1, 1, 2))
    return (d & e) | (c & d) | (b & c)


def _chunk(words: list[list[bytes]]) -> tuple[list[int], pa.Array, list[bytes]]:
    """Word counts, runs and collapsed texts of some documents."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    number: dict[bytes, int] = {}
    size = sum(map(len, words)) + len(words) + 1
    sequence, starts, at = np.empty(size, np.int64), np.zeros(len(words), np.int64), 1
    for i in order:
        starts[i] = at
        sequence[at : at + len(words[i])] = [number.setdefault(w, len(number)) for w in words[i]]
        at += len(words[i]) + 1
    edges = np.append(0, starts + [len(w) for w in words])
    sequence[edges] = len(number) + np.arange(len(edges))
    start, length, period = runs(sequence, [len(words[i]) for i in order])
    place = np.sort(starts)
    of = np.argsort(starts, kind="stable")[np.searchsorted(place, start, side="right") - 1] if len(start) else start
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change) > 0
    collapsed = []
    having = set(of.tolist())
    for i, w in enumerate(words):
        if i in having:
            out = dropped[starts[i] : starts[i] + len(w)].tolist()
            w = [x for x, gone in zip(w, out) if not gone]
        collapsed.append(b" ".join(w))
    by_row = np.lexsort((period, start, of))
    offsets = np.searchsorted(of[by_row], np.arange(len(words) + 1)).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(c[by_row], pa.int64()) for c in (start - starts[of], length, period)], ["start", "length", "period"])
    return [len(w) for w in words], pa.ListArray.from_arrays(pa.array(offsets), rows), collapsed


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, ``runs`` (array of start, length, period, by start and period) and ``collapsed`` of every row.

    Words are stretches without ASCII white space. ``collapsed`` is the text's words, joined by one space, without those that a run
    holds after its first period. NULL, empty and white-space texts have no words and no runs and collapse to the empty
    text. Each row counts for itself, so repeated ids and NULL ids are rows like others; other columns are ignored; an
    empty table gives no rows. A task holds the words of CHUNK or of one document.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()),
    ])

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            first, words, size = 0, [], 0
            for i, text in enumerate(texts):
                found = text.as_py().split()
                if words and size + len(found) > CHUNK:
                    yield made(ids, first, words)
                    first, words, size = i, [], 0
                words.append(found)
                size += len(found) + 1
            if words:
                yield made(ids, first, words)

    def made(ids, first, words):
        counts, found, collapsed = _chunk(words)
        columns = [ids.slice(first, len(words)), pa.array(counts, pa.int64()), found.cast(schema.field("runs").type), pa.array(collapsed, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    fields = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), whole_text(docs).alias("text")).mapInArrow(run, fields)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, best).alias("best"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The documents, with a period planted in one of ten.

    With h the crc32 of the id as text and g its tenth, rounded down, a text of n words with h % 10 = 0 goes on from word a = g % n with
    the words from there on repeated by p = 1 + (n - a) // (3 + g % 8). A NULL id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(whole_text(docs), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    marked = docs.select("doc_id", whole_text(docs).alias("text"), F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    marked = marked.withColumn("a", F.when(n > 0, F.col("g") % n))
    marked = marked.withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    places = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.array_join(F.transform(places, lambda i: F.get("words", place(i).cast("int"))), " ")
    return marked.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))
