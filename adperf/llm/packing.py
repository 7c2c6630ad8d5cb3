"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Each task tokenizes its documents in the order in which they come and gathers pieces until they fill GROUP windows but for a
small slack. A group's pieces are partitioned by differencing into as many windows as its tokens need; when one window
exceeds the capacity, the number of windows rises by one and the group is partitioned anew. Nothing is shuffled, and a
task holds one group of windows and one document.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import only_one, whole_text
from adperf.llm.tokens import Kept

CAPACITY = 2048
GROUP = 64  # windows of a group
SLACK = 8  # tokens of a window left free, so that near-equal windows fit
PIECE = 512  # longest piece that shares a window
FILLER, FILLER_PIECE = 1536, 12  # a group's last ids come as short pieces, by which differencing levels the windows
END_ID = 1


class WordTokenizer:
    """A text's ids as little-endian 32-bit bytes, equal to ``tokenizers`` on the whole text.

    A text of Latin letters, digits, ASCII signs and plain white space is cut at white space, each part into words by the
    tokenizer's own pattern, and each word is encoded once; parts and words are kept. Any other text, or one that holds a
    special token's string, goes through the library whole.
    """

    LETTERS, NUMBERS = "a-zªµºß-öø-ȳ", "0-9²³¹¼½¾"
    PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-ȳ]*").fullmatch
    WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}\\s]+").findall

    def __init__(self, path: str, cache: int = 250_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words = Kept(self.word, cache)
        self.parts = Kept(lambda part: b"".join(map(self.words.__getitem__, self.WORDS(part))), cache)

    def word(self, word: str) -> bytes:
        letters = word if word.isascii() else self.bytes_of(word)[0][0]
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        lowered = text.lower()  # which can leave the plain letters, as Ə does
        if self.PLAIN(text) and self.PLAIN(lowered) and not any(s in text for s in self.special):
            return b"".join(map(self.parts.__getitem__, lowered.split()))
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()


def tokenizer(path: str) -> WordTokenizer:
    return only_one(("words", path), lambda: WordTokenizer(path))


def difference(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: ``ways`` lists of indices into ``sizes`` with near-equal sums.

    A partial partition is kept as its non-empty parts, largest first. The two partitions of the widest spread are merged,
    the largest part of the one with the smallest of the other, until one is left; what all parts share is set aside.
    """
    if not sizes:
        return [[] for _ in range(ways)]
    # A part is (sum above the common base, tree of its indices); ties go by the order of creation.
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heapq.heappop(heap)[2]
        if len(a) + len(b) <= ways:
            parts = a + b
        else:
            fit = ways - len(b)  # so many of a's largest parts meet an empty part of b
            parts = a[:fit] + b[: ways - len(a)]
            for x, y in zip(a[fit:], reversed(b[ways - len(a) :])):
                parts.append((x[0] + y[0], (x[1], y[1])))
        parts.sort(key=_sum, reverse=True)
        if len(parts) == ways and (least := parts[-1][0]):
            parts = [(s - least, tree) for s, tree in parts]
        spread = parts[0][0] - (parts[-1][0] if len(parts) == ways else 0)
        heapq.heappush(heap, (-spread, made, parts))
        made += 1
    out = []
    for _, tree in heap[0][2]:
        indices, stack = [], [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            else:
                indices.append(node)
        out.append(sorted(indices))
    return out + [[] for _ in range(ways - len(out))]


def _sum(part):
    return part[0]


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Differencing into the least number of windows, from the sum's quotient upwards, of which none exceeds the capacity."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, ways)
        if max(sum(sizes[i] for i in w) for w in found) <= capacity:
            return [w for w in found if w]
        ways += 1


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents and their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the piece's ids (little-endian 32-bit).

    A document is its ids and END_ID. Whole windows are cut off a long one first; what is left is cut into pieces of at most
    PIECE ids, those that end a group into shorter ones. Every id lies in one piece. Sequence ids are unique: the task's partition
    number times 2^32, plus a count. Sequences are to be padded to ``capacity``, except one whose length is a power of two.

    NULL and empty texts are documents of END_ID alone. NULL doc_ids stay NULL. Repeated rows are documents each. Other
    columns are ignored. An empty table gives no rows.
    """
    limit = group * (capacity - SLACK)
    piece = min(PIECE, capacity)

    def run(batches):
        own = tokenizer(path)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        waiting: list[tuple] = []  # (doc_id, start, length, crc32, doc_tokens, ids)
        held = 0

        def placed(pieces, window):
            nonlocal sequence
            offset = 0
            for i in window:
                doc, start, length, crc, tokens, ids = pieces[i]
                rows.append((doc, start, length, crc, tokens, sequence, offset, ids))
                offset += length
            sequence += 1

        def close():
            nonlocal waiting, held
            for window in windows([p[2] for p in waiting], capacity):
                placed(waiting, window)
            waiting, held = [], 0

        def flushed():
            nonlocal rows
            columns, rows = list(zip(*rows)), []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = memoryview(own.encode(text) + END_ID.to_bytes(4, "little"))
                tokens, start = len(ids) // 4, 0
                while start < tokens:
                    alone = tokens - start >= capacity
                    longest = piece if held < limit - FILLER else FILLER_PIECE
                    length = capacity if alone else min(longest, tokens - start, limit - held)
                    part = ids[4 * start : 4 * (start + length)]
                    entry = (doc, start, length, zlib.crc32(part), tokens, bytes(part) if with_ids else None)
                    start += length
                    if alone:
                        placed([entry], [0])
                        continue
                    waiting.append(entry)
                    held += length
                    if held == limit:
                        close()
                if len(rows) >= 10_000:
                    yield flushed()
        if waiting:
            close()
        if rows:
            yield flushed()

    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    packed = docs.select(F.col("doc_id").cast("long"), whole_text(docs).alias("text")).mapInArrow(run, fields)
    return packed if with_ids else packed.drop("ids")
