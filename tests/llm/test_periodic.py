"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from adperf.llm import periodic, queries


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def varied(rnd):
    words = [str(rnd.randrange(rnd.choice([1, 2, 3, 5]))) for _ in range(rnd.randint(0, rnd.choice([5, 30, 120])))]
    if words and rnd.random() < 0.5:
        a = rnd.randrange(len(words))
        p = rnd.randint(1, max(1, (len(words) - a) // 3))
        words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
        if rnd.random() < 0.5:
            words[rnd.randrange(len(words))] = "x"
    return [w.encode() for w in words]


def test_chunks_of_documents_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(250):
        docs = [varied(rnd) for _ in range(rnd.randint(1, 12))]
        counts, rows, texts = periodic._chunk(docs)
        assert counts == [len(w) for w in docs]
        for words, row, text in zip(docs, rows.to_pylist(), texts):
            wanted = brute_runs(words)
            assert [(r["start"], r["length"], r["period"]) for r in row] == wanted
            assert text == collapsed(words, wanted)


def test_extensions_equal_direct_comparison():
    rnd = random.Random(4)
    for kinds, n in ((1, 50), (2, 300), (3, 300), (40, 200)):
        words = [rnd.randrange(kinds) for _ in range(n)]
        words[n // 2 :] = words[: n - n // 2]
        x = np.array([kinds, *words, kinds + 1])
        grammar = periodic.Grammar(x)
        pairs = [sorted(rnd.sample(range(1, n + 1), 2)) for _ in range(500)]
        a, b = np.array(pairs).T

        def plain(i, j, step):
            length = 0
            while x[i] == x[j]:
                i, j, length = i + step, j + step, length + 1
            return length

        assert grammar.extensions(a, b).tolist() == [plain(i, j, 1) for i, j in pairs]
        last = len(x) - 1
        assert grammar.reversed().extensions(last - b, last - a).tolist() == [plain(i, j, -1) for i, j in pairs]


def test_few_queries_at_a_time_and_small_chunks(monkeypatch):
    rnd = random.Random(3)
    docs = [varied(rnd) for _ in range(60)] + [[b"a"] * 3000, [b"a", b"b"] * 900]
    whole = periodic._chunk(docs)
    monkeypatch.setattr(periodic, "QUERIES", 20)
    parts = periodic._chunk(docs)
    assert whole[1].to_pylist() == parts[1].to_pylist() and whole[2] == parts[2]
    assert whole[1].to_pylist()[-2:] == [[{"start": 0, "length": 3000, "period": 1}], [{"start": 0, "length": 1800, "period": 2}]]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_query_equals_brute_force(spark, small, odd, table, monkeypatch):
    docs = small("documents") if table == "documents" else odd
    docs = docs.withColumn("runs", F.lit("x")).withColumn("words", F.lit("x"))
    found = periodic.digest(periodic.periodic_runs(periodic.with_planted_period(docs))).collect()
    rows = docs.collect()
    assert len(found) == len(rows)
    wanted = []
    for r in rows:
        words = planted(r.doc_id, r.text)
        each = brute_runs(words)
        best = max(each, key=lambda e: (e[1], -e[0], -e[2]), default=(None,) * 3)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in each)
        sha = [hashlib.sha256(t).hexdigest() for t in (lines.encode(), collapsed(words, each))]
        wanted.append((r.doc_id, len(each), *best, 1000 * best[1] // best[2] if each else None, *sha))
    key = lambda t: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in t)
    assert sorted((tuple(f) for f in found), key=key) == sorted(wanted, key=key)


def test_empty_table(spark, odd):
    assert periodic.digest(periodic.periodic_runs(periodic.with_planted_period(odd.limit(0)))).count() == 0


def test_registered(spark):
    assert "op11_periodic_runs" in queries.QUERIES
