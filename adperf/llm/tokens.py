"""Token counts by byte-pair merging, without emitting token identifiers.

A text is cut into segments over which no vocabulary piece can reach, so merging each segment alone gives the same
pieces as merging the whole text. A segment's adjacent pairs wait in a heap; the pair of the lowest rank, leftmost first,
is merged in a linked list of symbols, and the count is the number of initial symbols minus the number of merges.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import only_one, whole_text

SPACE = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


POSITION_BITS = 33  # of a heap entry; the rank stands above them


class Kept(dict):
    """Key -> ``make(key)``. Two generations of at most ``size`` entries each bound its memory; keys of more than 64
    characters are made each time."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class MergeCounter:
    """Token counts of one vocabulary. Counts of segments are kept, and those of whole words between spaces."""

    def __init__(self, path: str, cache: int = 500_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.normalize = model.normalize
        self.symbols = {p for p in pieces if len(p) == 1}
        order = {score: n for n, score in enumerate(sorted(set(pieces.values())))}
        self.rank = {p: order[score] << POSITION_BITS for p, score in pieces.items() if len(p) > 1}
        if not all(c in self.symbols for p in self.rank for c in p):
            raise ValueError("a piece holds a character that is no piece itself; such models are not supported")
        pattern, self.spaced = self._segments()
        self.cut = re.compile(pattern, re.DOTALL).findall
        self.segments = Kept(self.merged, cache)
        self.words = Kept(lambda word: self.slow(SPACE + word), cache)

    def _segments(self) -> tuple[str, bool]:
        """A pattern that cuts where no piece crosses: before a space mark, around line ends, behind a run of letters; and
        whether the first holds. A cut that the vocabulary does not allow is left out."""

        def crossed(pattern: str) -> bool:
            return any(map(re.compile(pattern, re.DOTALL).search, self.rank))

        if crossed(f"[^{SPACE}]{SPACE}"):
            return ".+", False
        if crossed("\n") or crossed(f"[{LETTERS}][^{LETTERS}{SPACE}]"):
            return f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", True
        return f"\n|{SPACE}*[^{SPACE}\n{LETTERS}]*[{LETTERS}]+|{SPACE}*[^{SPACE}\n{LETTERS}]+|{SPACE}+", True

    def merged(self, segment: str) -> int:
        """Initial symbols minus merges; a character outside the vocabulary counts its bytes and is never merged."""
        rank, parts, end, symbols = self.rank.get, list(segment), len(segment), self.symbols
        count = end
        for c in parts:
            if c not in symbols:
                count += len(c.encode()) - 1
        heap = [r + i for i in range(end - 1) if (r := rank(segment[i : i + 2])) is not None]
        heapq.heapify(heap)
        after, before = list(range(1, end + 1)), list(range(-1, end))
        pop, push, mask = heapq.heappop, heapq.heappush, (1 << POSITION_BITS) - 1
        while heap:
            lowest = pop(heap)
            i = lowest & mask
            j = after[i]
            if j >= end or not parts[i] or rank(joined := parts[i] + parts[j]) != lowest - i:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = joined, ""
            count -= 1
            k = after[i] = after[j]
            before[k] = i
            if k < end and (r := rank(joined + parts[k])) is not None:
                push(heap, r + i)
            h = before[i]
            if h >= 0 and (r := rank(parts[h] + joined)) is not None:
                push(heap, r + h)
        return count

    def slow(self, normal: str) -> int:
        return sum(map(self.segments.__getitem__, self.cut(normal)))

    def count(self, text: str) -> int:
        if not text:
            return 0
        normal = self.normalize(text)
        if not self.spaced or not normal.startswith(SPACE) or normal.endswith(SPACE) or SPACE + SPACE in normal:
            return self.slow(normal)
        return sum(map(self.words.__getitem__, normal[1:].split(SPACE)))


def counter(path: str) -> MergeCounter:
    """The counter of a vocabulary file, kept by the Python worker; workers are reused, so its tables serve many tasks."""
    return only_one(("merges", path), lambda: MergeCounter(path))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (``n_tokens > limit``) of every row's whole text.

    ``model_path`` is a sentencepiece BPE model that every worker can open. Counts equal ``encode`` without begin and end
    tokens; control strings inside a text are ordinary text. NULL and empty texts have 0 tokens. Repeated rows are counted
    one by one, NULL ids stay NULL, other columns are ignored, and an empty table gives no rows.
    """

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        one = counter(model_path)
        return pd.Series([one.count(t) for t in texts], dtype="int64")

    text = whole_text(docs)
    counted = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
