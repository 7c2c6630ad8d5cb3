"""Near-duplicate operators against brute force."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from adperf.llm import common, nn_descent, odd_sketch, spotsigs
from adperf.llm.components import connected_components


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected_components(rows, percent=85):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(ids, linked)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (2000, -7)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    wanted = components({n for e in edges for n in e}, edges)
    assert all(found.get(n, n) == c for n, c in wanted.items()) and set(found) <= set(wanted)


def near_copies(n=60):
    """A chain of edits: neighbours are links, the ends are not."""
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        words = words[:]
        words[(i * 37) % 400] = f"edit{i}"
        out.append((1000 + i, " ".join(words)))
    return out


def test_near_documents(spark, small, odd):
    chain = spark.createDataFrame(near_copies() + [(2000 + i, near_copies(1)[0][1].upper()) for i in range(30)], "doc_id long, text string")
    varied = spark.createDataFrame(copies_of_many_edits(), "doc_id long, text string")
    for docs in (small("documents"), odd, chain, varied):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        sets, wanted = expected_components(rows)
        found = odd_sketch.near_duplicates(docs).collect()
        assert len(found) == len(rows)
        for r in found:
            assert r.component_id == wanted.get(r.doc_id)
            assert r.kept == (r.doc_id is None or r.doc_id == wanted[r.doc_id])
            assert r.doc_id is None or r.n_shingles == len(sets[r.doc_id])
        kept = odd_sketch.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        ids = [r.doc_id for r in kept.collect()]
        assert sorted(i for i in ids if i is not None) == sorted(set(wanted.values()))
        assert ids.count(None) == sum(i is None for i, _ in rows)
    assert odd_sketch.near_duplicates(odd.limit(0)).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    base, other = ([f"{c}{i}" for i in range(100)] for c in "ab")
    texts = {"base": base, "other": other, "base x": [*base, "x"], "other x": [*other, "x"], "other y": [*other, "y"]}
    rows = [(1, "base"), (1, "other"), (2, "base x"), (3, "other x"), (4, "other y"), (1, ""), (1, "base")]
    key = {name: odd_sketch.set_key(odd_sketch.shingles(" ".join(w))) for name, w in texts.items()}
    chosen = min(("base", "other"), key=key.get)
    wanted = {1: 1, 2: 1 if chosen == "base" else 2, 3: 1 if chosen == "other" else 3, 4: 1 if chosen == "other" else 3}
    for parts in (1, 3, 7):
        docs = spark.createDataFrame([(i, " ".join(texts.get(t, []))) for i, t in rows], "doc_id long, text string").repartition(parts)
        found = odd_sketch.near_duplicates(docs).collect()
        assert sorted((r.doc_id, r.component_id) for r in found) == sorted((i, wanted[i]) for i, _ in rows)
        assert sorted(r.n_shingles for r in found) == [0, 96, 96, 96, 97, 97, 97]
        assert sorted(r.doc_id for r in odd_sketch.drop_near_duplicates(docs).collect()) == sorted(set(wanted.values()))


def test_scan_is_thinned_without_losing_rows(spark, monkeypatch):
    rows = spark.range(20_000).select(F.col("id"), F.lit("x").alias("text"))
    wanted = spark.range(0, 20_000, 97)
    left = common.possibly_wanted(rows, "id", wanted)
    assert left.columns == ["id", "text"]
    assert wanted.join(left, "id", "left_anti").count() == 0 and left.count() < 2_000
    monkeypatch.setattr(common, "MOST_BITS", 64)  # far too few: more rows pass, none is lost
    assert wanted.join(common.possibly_wanted(rows, "id", wanted), "id", "left_anti").count() == 0
    assert common.possibly_wanted(rows, "id", wanted.limit(0)).count() == 0


def test_largest_xor_bounds_the_estimate():
    rng = np.random.default_rng(5)
    for percent, n in ((85, 400), (80, 400), (95, 1000)):
        both = int(n * 2 * percent / (100 + percent)) + 1
        counts = []
        for _ in range(60):
            a = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
            x, y = (odd_sketch.odd_sketch(odd_sketch.samples(np.unique(s), percent)) for s in (a[:n], a[n - both :]))
            counts.append(int(np.bitwise_count((x ^ y).view(np.uint64)).sum()))
        limit = odd_sketch.largest_xor(percent)
        assert max(counts) <= limit < np.mean(counts) + 7.5 * max(np.std(counts), 5)


def copies_of_many_edits(n=240):
    """One text with few to many words replaced: some copies link with most others, some with none, their buckets are shared."""
    rnd, base = random.Random(8), [f"w{i}" for i in range(200)]
    out = []
    for i in range(n):
        words = base[:]
        for k, at in enumerate(rnd.sample(range(200), i % 9)):
            words[at] = f"edit{rnd.randrange(4) if i % 3 else i * 10 + k}"  # some edits are shared
        out.append((5000 + i, " ".join(words)))
    return out


def test_shared_parts_bound_the_intersection(spark):
    rows = [(i, t) for i, t in copies_of_many_edits(80)]
    sets = {i: odd_sketch.shingles(t).view(np.int64) for i, t in rows}
    sets[9000] = np.zeros(0, np.int64)
    table = spark.createDataFrame([(i, s.tolist()) for i, s in sets.items()], "id long, set array<long>")
    found = {r.id: np.array(r.parts) for r in odd_sketch.shared_parts(table).collect()}
    assert set(found) == set(sets)
    for a in sets:
        others = set().union(*(sets[b].tolist() for b in sets if b != a))
        wanted = np.bincount(np.array([s % odd_sketch.PARTS for s in sets[a].tolist() if s in others], int), minlength=odd_sketch.PARTS)
        assert (found[a] == wanted).all()
        assert all(len(np.intersect1d(sets[a], sets[b])) <= np.minimum(found[a], found[b]).sum() for b in sets if b != a)


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for differ, similarity in ((0, 1.0), (80, 1840 / 2160), (400, 1200 / 2800)):
        pairs = [np.concatenate([base[: 2000 - 2 * differ], rng.integers(0, 1 << 63, differ * 2, dtype=np.uint64)]) for _ in range(2)]
        if differ:
            similarity = (2000 - 2 * differ) / (2000 + 2 * differ)
        a, b = (odd_sketch.odd_sketch(odd_sketch.samples(p)) for p in (pairs if differ else (base, base)))
        xor = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
        assert (xor <= odd_sketch.largest_xor()) == (similarity > 0.6)
        if similarity > 0.8:
            assert abs(odd_sketch.sketch_similarity(xor) - similarity) < 0.12


def test_near_embeddings(spark, small):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 8] + 0.05 * rng.standard_normal(16)).tolist()) for i in range(200)]  # saturated lists
    rows += [(400 + i, base[3].tolist()) for i in range(30)]  # equal vectors
    rows += [(500, (2 * base[5]).tolist()), (501, None), (502, []), (503, [0.0] * 16), (504, [float("nan")] + [1.0] * 15),
             (505, [None] + [1.0] * 15), (506, [float("inf")] + [1.0] * 15), (507, [1.0, 0.0]), (508, [1.0, 0.01]), (0, base[0].tolist())]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, weight string")
    for embeddings in (table, small("embeddings")):
        vectors = {r.vec_id: np.array(r.embedding, float) for r in embeddings.collect()
                   if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)}
        ids = sorted(vectors)
        unit = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
        linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
        every = sorted({r.vec_id for r in embeddings.collect()})
        wanted, degree = components(every, linked), {i: 0 for i in every}
        for a, b in linked:
            degree[a] += 1
            degree[b] += 1
        found = nn_descent.near_embeddings(embeddings).collect()
        assert len(found) == embeddings.count()
        assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found} == {(i, degree[i], wanted[i], wanted[i] == i) for i in every}
    assert nn_descent.near_embeddings(table.limit(0)).count() == 0


def crossing_groups(rng, n=700, size=12):
    """Unlinked vectors and, last, two tight groups of which every vector links with all of the other group, but less closely."""
    far = rng.standard_normal((n, 64))
    one = rng.standard_normal(64)
    aside = rng.standard_normal(64)
    aside -= one * (aside @ one) / (one @ one)
    other = one + np.tan(np.arccos(0.965)) * aside * np.linalg.norm(one) / np.linalg.norm(aside)
    near = [v + 0.01 * rng.standard_normal(64) for v in [one] * size + [other] * size]
    return np.concatenate([far, near])


def brute_links(rows):
    x = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    return linked


def same_as_brute_force(spark, rows, ids):
    linked = brute_links(rows)
    wanted = components(ids, [(ids[i], ids[j]) for i, j in zip(*map(list, np.nonzero(linked)))])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, rows)], "vec_id long, embedding array<double>")
    found = nn_descent.near_embeddings(table).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == {(i, int(linked[k].sum()), wanted[i]) for k, i in enumerate(ids)}


def test_links_between_groups_that_fill_their_lists(spark):
    rows = crossing_groups(np.random.default_rng(6))
    x = rows[-24:] / np.linalg.norm(rows[-24:], axis=1, keepdims=True)
    assert (x @ x.T).min() >= 0.95 and (x[:12] @ x[:12].T).min() > (x[:12] @ x[12:].T).max()
    # Ids that the audit draws last: its links cannot help.
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit(nn_descent.SEED)), F.lit(1 << 20))
    last = [r.id for r in spark.range(10_000, 11_000).orderBy(F.desc(draw)).limit(24).collect()]
    same_as_brute_force(spark, rows, [*range(len(rows) - 24), *last])


def test_unfinished_graph_is_completed(spark, monkeypatch):
    """Lists that no round improves, and an audit of few vectors: the audit notices, and nothing is missing in the result."""
    rng = np.random.default_rng(7)
    base = rng.standard_normal((900, 64))
    rows = np.concatenate([base, base[:300] + 0.1 * rng.standard_normal((300, 64)), crossing_groups(rng, 0)])
    monkeypatch.setattr(nn_descent, "refine", lambda graph, *_: graph.limit(0).select("a", "b", "similarity"))
    monkeypatch.setattr(nn_descent, "ORDERS", 1)
    monkeypatch.setattr(nn_descent, "AUDITED", 10, raising=False)
    same_as_brute_force(spark, rows, list(range(len(rows))))


def test_fingerprints(small, odd):
    for docs in (small("documents"), odd):
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        smallest = {}
        for i, t in sorted((r for r in rows if r[0] is not None), reverse=True):
            smallest[i] = t  # the last, so the smallest, text of an id
        ids = sorted(smallest, reverse=True)
        after = dict(zip(ids, ids[1:] + ids[:1]))
        found = spotsigs.compare_with_edits(docs).collect()
        prints = {r.doc_id: set(r.fingerprint.split()) for r in found}
        wanted = []
        for i, t in rows:
            k = len(t) // 3
            edited = t[: len(t) - k] + (smallest[after[i]][:k] if i is not None else "")
            wanted.append((i or 0, len(t), hashlib.sha256(edited.encode()).hexdigest()))
        assert sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in found) == sorted(wanted)
        for r in found:
            a, b = set(r.fingerprint.split()), set(r.edited_fingerprint.split())
            assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
            if r.doc_id is not None:
                c = prints[after[r.doc_id]]
                assert abs(r.near_next - (len(a & c) / len(a | c) if a | c else 1.0)) < 1e-12
    assert spotsigs.compare_with_edits(odd.limit(0)).count() == 0


def test_each_row_of_an_id_is_edited_by_its_own_third(spark):
    docs = spark.createDataFrame([(1, "abcdefghi"), (1, "abc"), (1, ""), (0, "XYZ")], "doc_id long, text string")
    found = {(r.doc_id, r.n_chars): r.edited_sha256 for r in spotsigs.compare_with_edits(docs).collect()}
    wanted = {(1, 9): "abcdefXYZ", (1, 3): "abX", (1, 0): "", (0, 3): "XY"}
    assert found == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in wanted.items()}


def test_signatures_are_chains_behind_anchors(spark):
    texts = spark.createDataFrame([("The house of the red door",), ("house red door",), ("¡!",), ("",)], "text string")
    found = [set(r.s) for r in texts.select(spotsigs.signatures(F.col("text")).alias("s")).collect()]
    chain = lambda *w: spark.range(1).select(F.hash(*map(F.lit, w))).first()[0]
    assert found[0] == {chain("the", "house red"), chain("of", "red door"), chain("the", "red door")}
    assert found[1] == {chain("house red"), chain("red door"), chain("door ")}
    assert len(found[2]) == 1 and found[3] == set()


def test_fingerprint_pairs(spark, small):
    copies = spark.createDataFrame([(10_000 + i, t) for i, (_, t) in enumerate(near_copies(12))], "doc_id long, text string")
    docs = small("documents").select("doc_id", "text").unionByName(copies)
    pairs, members = spotsigs.near_pairs(docs)
    signs = {r.doc_id: frozenset(r.s) for r in docs.select("doc_id", spotsigs.signatures(F.coalesce("text", F.lit(""))).alias("s")).collect()}
    first = {}
    for i in sorted(signs):
        first.setdefault(signs[i], i)
    sets = {i: s for s, i in first.items() if s}
    names = sorted(sets)
    wanted = {(b, a) for k, a in enumerate(names) for b in names[:k] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == wanted and wanted
    assert {(r.doc_id, r["class"]) for r in members.collect()} == {(i, first[s]) for i, s in signs.items() if s}
    like = {(x, y): len(sets[x] & sets[y]) / len(sets[x] | sets[y]) for a, b in wanted for x, y in ((a, b), (b, a))}
    expected = set()
    for i, s in signs.items():
        of = first[s] if s else i
        near = sorted((-v, y) for (x, y), v in like.items() if x == of)
        expected.add((i, of, len(near), near[0][1] if near else None, -near[0][0] if near else None))
    assert {tuple(r) for r in spotsigs.near_documents(docs).collect()} == expected


def test_near_documents_with_repeated_ids_and_without_texts(spark):
    long = "the quick fox and the lazy dog of a town in the north"
    rows = [(1, long), (1, long), (1, "the other words of a text"), (2, long), (3, ""), (4, None), (3, None), (None, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("x")).withColumn("signs", F.lit(1))
    found = sorted(spotsigs.near_documents(docs).collect())
    assert [r.doc_id for r in found] == [1, 2, 3, 4]
    assert [(r["class"], r.n_links, r.nearest) for r in found[2:]] == [(3, 0, None), (4, 0, None)]
    assert found[0]["class"] == 1 and found[1]["class"] in (1, 2) and not any(r.n_links for r in found)
    assert spotsigs.near_documents(docs.limit(0)).count() == 0


def test_near_documents_makes_signatures_once_and_keeps_shared_ones(spark, small, monkeypatch):
    written = {}

    def watched(df, name):
        written[name] = df, common.stored(df, name)
        return written[name][1]

    monkeypatch.setattr(spotsigs, "stored", watched)
    copies = spark.createDataFrame([(10_000 + i, t) for i, (_, t) in enumerate(near_copies(12))], "doc_id long, text string")
    spotsigs.near_documents(copies).count()
    sets, index = written["spot-sets"][1], written["spot-index"][1]
    often = sets.select(F.explode("signs").alias("sign")).groupBy("sign").count()
    assert index.count() and index.join(often, "sign").filter("count < 2").isEmpty()
    spotsigs.near_documents(small("documents")).count()
    plan = written["spot-found"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(lower(") == 1


def test_ring_of_sparse_ids(spark):
    rnd = random.Random(9)
    ids = sorted({rnd.randint(-(1 << 62), 1 << 62) for _ in range(200)} | {0, -1, 8191, 8192, (1 << 63) - 1, -(1 << 63)}, reverse=True)
    found = {r.doc_id: r.next_id for r in spotsigs.ring(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()}
    assert found == dict(zip(ids, ids[1:] + ids[:1]))
