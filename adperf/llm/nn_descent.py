"""Near-duplicate embeddings by NN-descent.

A neighbour graph starts from random-projection orders and is refined through joins of neighbours of neighbours. Each
round, a vector's forward and sampled reverse neighbours are compared with each other, and every vector keeps its best.
Rounds go on, with longer lists, while they find links and while an audit against brute force finds links missing; if they
end before that, all nodes are compared with all. A component that holds a list full of links is compared with all nodes
too, but for those that a bound on angles excludes. Equal vectors are one node throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adperf.llm.common import stored
from adperf.llm.components import connected_components

THRESHOLD = 0.95
NEIGHBOURS = 10  # length of a list, until it is saturated
ORDERS = 8  # random-projection orders of the first graph
AHEAD = 3  # predecessors in an order that a vector is compared with
ROUNDS = 12  # at most; what they leave unsettled or unproven is compared exactly
STEADY = 6  # rounds before lists grow in any case
GROWTH = 4  # lists grow to so many times their first length
AUDIT, AUDIT_MOST = 256, 16_384  # vectors whose links are audited by brute force, drawn by hash: first, and at most
AUDITED = 64  # audited vectors that must have links, else more are drawn
RECALL = 1.0  # of the audited links; below it, rounds go on
BLOCK = 512  # vectors of a block
CHUNK = 16 << 20  # bytes of vectors that travel with the tasks of one pass
SEED = 17


def unit(rows: list[bytes]) -> np.ndarray:
    """Stored vectors (64-bit components) as unit rows."""
    found = np.stack([np.frombuffer(r, np.float64) for r in rows])
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): components as 64-bit numbers in bytes, of vectors that can be compared. Of rows that share a
    vec_id one holds (the smallest)."""

    def run(batches):
        for batch in batches:
            ids, vectors = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
                if not v or any(x is None for x in v):
                    continue
                x = np.asarray(v, np.float64)
                scale = np.abs(x).max()
                if np.isfinite(scale) and scale > 0:
                    ids.append(i)
                    vectors.append((x / scale + 0.0).tobytes())
            yield _batch({"vec_id": pa.array(ids, pa.int64()), "vector": pa.array(vectors, pa.binary())})

    rows = embeddings.filter("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    found = rows.mapInArrow(run, "vec_id long, vector binary")
    return found.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def first_graph(nodes: DataFrame, seed: int = SEED) -> DataFrame:
    """(a, b, similarity) of each vector with its AHEAD predecessors in ORDERS random-projection orders.

    An order sorts by the signs of 32 random projections, then by one projection. Rows are dealt by range of that key, so
    a dense spot is spread over tasks like any other.
    """

    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("vector").to_pylist()
            out = {"turn": [], "code": [], "along": [], "id": [], "vector": []}
            by_size: dict[int, list[int]] = {}
            for i, r in enumerate(rows):
                by_size.setdefault(len(r) // 8, []).append(i)
            ids = batch.column("id").to_pylist()
            for size, at in by_size.items():
                x = unit([rows[i] for i in at])
                for turn in range(ORDERS):
                    planes = np.random.default_rng([seed, turn, size]).standard_normal((size, 33))
                    side = x @ planes
                    code = (side[:, :32] > 0) @ (1 << np.arange(31, -1, -1, dtype=np.int64))
                    out["turn"] += [turn * 100_000 + size] * len(at)
                    out["code"] += code.tolist()
                    out["along"] += side[:, 32].tolist()
                    out["id"] += [ids[i] for i in at]
                    out["vector"] += [rows[i] for i in at]
            yield _batch(out)

    def compared(batches):
        last: list[tuple] = []
        for batch in batches:
            a, b, s = [], [], []
            for turn, i, v in zip(*(batch.column(c).to_pylist() for c in ("turn", "id", "vector"))):
                x = np.frombuffer(v, np.float64)
                x = x / np.linalg.norm(x)
                last = [p for p in last if p[0] == turn][-AHEAD:]
                for _, j, y in last:
                    a.append(i)
                    b.append(j)
                    s.append(float(x @ y))
                last.append((turn, i, x))
            yield _batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64())})

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.mapInArrow(keys, "turn long, code long, along double, id long, vector binary")
    order = ("turn", "code", "along", "id")
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("turn", "id", "vector")
    return dealt.mapInArrow(compared, "a long, b long, similarity double")


def best(edges: DataFrame, length: int) -> DataFrame:
    """Each vector's ``length`` most similar neighbours. Ranks are limited before the shuffle too, so a hub's edges do not
    meet in one task."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    both = both.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= length).drop("rank")


def refine(graph: DataFrame, nodes: DataFrame, length: int, turn: int) -> DataFrame:
    """Pairs (a, b, similarity) among each vector's neighbours that would enter one of their lists.

    A centre has itself, its list and at most ``length`` reverse neighbours, drawn anew each turn, so no group exceeds
    2 * length + 1 rows.
    """
    reverse = Window.partitionBy("centre").orderBy(F.xxhash64("member", "centre", F.lit(turn)))
    backward = graph.select(F.col("b").alias("centre"), F.col("a").alias("member"))
    backward = backward.withColumn("rank", F.row_number().over(reverse)).filter(F.col("rank") <= length).drop("rank")
    groups = graph.select(F.col("a").alias("centre"), F.col("b").alias("member")).unionByName(backward)
    groups = groups.unionByName(graph.select(F.col("a").alias("centre"), F.col("a").alias("member"))).distinct()
    worst = graph.groupBy("a").agg(F.min("similarity").alias("worst"), F.count("*").alias("entries"))
    bar = F.when(F.col("entries") < length, -2.0).otherwise(F.col("worst"))
    members = nodes.join(worst, F.col("id") == F.col("a"), "left").select("id", "vector", F.coalesce(bar, F.lit(-2.0)).alias("bar"))
    groups = groups.join(members, F.col("member") == F.col("id")).select("centre", "member", "vector", "bar")

    def run(batches):
        group: list[tuple] = []
        out: tuple[list, list, list] = ([], [], [])

        def close():
            by_size: dict[int, list[tuple]] = {}
            for row in group:
                by_size.setdefault(len(row[2]), []).append(row)
            for rows in by_size.values():
                x = unit([r[2] for r in rows])
                similar = x @ x.T
                bars = np.array([r[3] for r in rows])
                wanted = np.triu(similar > np.minimum(bars[:, None], bars[None, :]), 1)
                # Of each row its few best: lists take no more of one group.
                top = np.argsort(-similar, axis=1)[:, : 1 + max(3, length // 3)]
                chosen = np.zeros_like(wanted)
                np.put_along_axis(chosen, top, True, axis=1)
                for i, j in zip(*np.nonzero(wanted & (chosen | chosen.T))):
                    out[0].append(rows[i][1])
                    out[1].append(rows[j][1])
                    out[2].append(float(similar[i, j]))

        def flushed():
            made = _batch({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64()), "similarity": pa.array(out[2], pa.float64())})
            for column in out:
                column.clear()
            return made

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("centre", "member", "vector", "bar"))):
                if group and group[0][0] != row[0]:
                    close()
                    group = []
                group.append(row)
            yield flushed()
        if group:
            close()
        yield flushed()

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return groups.repartition(parts, "centre").sortWithinPartitions("centre").mapInArrow(run, "a long, b long, similarity double")


def audit(nodes: DataFrame, threshold: float, size: int = AUDIT) -> DataFrame:
    """(a, b, similarity): all links of about ``size`` vectors, by brute force against all rows in blocks. The queries,
    at most 2 * ``size`` vectors, travel with the tasks."""
    n = nodes.count()
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit(SEED)), F.lit(1 << 20))
    drawn = nodes.filter(draw < int(min(1.0, size / max(1, n)) * (1 << 20))).limit(2 * size).collect()  # bounded
    queries: dict[int, tuple] = {}
    for length in {len(r["vector"]) for r in drawn}:
        rows = [r for r in drawn if len(r["vector"]) == length]
        queries[length] = (np.array([r["id"] for r in rows]), unit([bytes(r["vector"]) for r in rows]))

    def run(batches):
        for batch in batches:
            ids, rows = batch.column("id").to_pylist(), batch.column("vector").to_pylist()
            a, b, s = [], [], []
            for length, (names, x) in queries.items():
                at = [i for i, r in enumerate(rows) if len(r) == length]
                for start in range(0, len(at), BLOCK):
                    part = at[start : start + BLOCK]
                    similar = x @ unit([rows[i] for i in part]).T
                    for i, j in zip(*np.nonzero(similar >= threshold)):
                        if names[i] != ids[part[j]]:
                            a.append(int(names[i]))
                            b.append(ids[part[j]])
                            s.append(float(similar[i, j]))
            yield _batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64())})

    return nodes.mapInArrow(run, "a long, b long, similarity double")


def audited(nodes: DataFrame, threshold: float) -> tuple[DataFrame, bool]:
    """The audit's links, and whether they say enough: AUDITED of its vectors have links, or it holds all vectors. More
    vectors are drawn until one is so or AUDIT_MOST are reached."""
    n, size = nodes.count(), AUDIT
    while True:
        truth = stored(audit(nodes, threshold, size), "nn-audit")
        if size >= n or truth.select("a").distinct().count() >= AUDITED:
            return truth, True
        if size >= AUDIT_MOST:
            return truth, False
        size *= 4


def saturated_nodes(graph: DataFrame, threshold: float, length: int) -> DataFrame:
    """(a): nodes whose list holds nothing but links, so that it may lack others."""
    links = graph.filter(F.col("similarity") >= threshold).groupBy("a").agg(F.count("*").alias("n"))
    return links.filter(F.col("n") >= length).select("a")


def neighbour_graph(nodes: DataFrame, threshold: float, length: int) -> tuple[DataFrame, int, float, bool]:
    """Lists of neighbours, their length, the audited recall and whether the lists can be relied on.

    The recall is that of the lists alone: an audited link counts as found if a list has it, or if one of its nodes is
    saturated and so will be compared with all nodes. Lists are reliable when a round found no link for a list with room,
    and the audit, which must say enough, misses none. Lists and samples of reverse neighbours grow otherwise.
    """
    most = GROWTH * length
    graph = stored(best(first_graph(nodes), length), "nn-graph")
    truth, enough = audited(nodes, threshold)
    if not enough:
        return graph, length, 0.0, False
    total = truth.count()
    recall = 0.0
    for turn in range(ROUNDS):
        new = refine(graph, nodes, length, turn)
        improved = stored(best(graph.unionByName(new), length), "nn-graph")
        full = saturated_nodes(improved, threshold, length)
        added = improved.filter(F.col("similarity") >= threshold).join(graph, ["a", "b"], "left_anti")
        settled = added.join(full, "a", "left_anti").isEmpty()
        graph = improved
        missing = truth.join(graph, ["a", "b"], "left_anti")
        missing = missing.join(graph.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        missing = missing.join(full, "a", "left_anti").join(full.select(F.col("a").alias("b")), "b", "left_anti")
        recall = 1 - missing.count() / total if total else 1.0
        if settled and recall >= RECALL:
            return graph, length, recall, True
        if (settled or turn >= STEADY) and length < most:
            length *= 2
    return graph, length, recall, False


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of a[k] and b[k]; ``root`` names each place's class by its first place."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root[:] = root[root]


class Queries:
    """Vectors of one length in groups, each with its mean direction and the largest angle to it."""

    def __init__(self, names: list[int], groups: list, vectors: list[bytes]):
        order = sorted(range(len(names)), key=lambda i: groups[i])
        self.names = np.array([names[i] for i in order], np.int64)
        self.x = unit([vectors[i] for i in order])
        starts = [k for k, i in enumerate(order) if k == 0 or groups[i] != groups[order[k - 1]]]
        self.spans = list(zip(starts, starts[1:] + [len(order)]))
        centres = np.stack([self.x[lo:hi].mean(axis=0) for lo, hi in self.spans])
        norms = np.linalg.norm(centres, axis=1, keepdims=True)
        self.centres = np.where(norms > 1e-9, centres / np.where(norms > 1e-9, norms, 1), self.x[starts])
        self.radii = np.array([np.arccos(np.clip(self.x[lo:hi] @ c, -1, 1)).max() for (lo, hi), c in zip(self.spans, self.centres)])


def compare(nodes: DataFrame, queries: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked): for the nodes named in ``queries`` (id, component), exactly, the weight of all their links, and
    pairs (a, b) that connect just what these links connect.

    Queries travel with the tasks, CHUNK bytes a pass, and meet every node there, so no pair of vectors is shuffled.
    They are grouped in blocks of one component. By the triangle inequality of angles, a node farther from a block's
    centre than the block's radius and the threshold's angle together links with none of it.
    """
    members = queries.join(nodes, "id").select("id", "component", "vector")
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    placed = stored(placed.select("id", "component", "block", "vector"), "nn-queries")
    passes = max(1, -(-(placed.agg(F.sum(F.length("vector"))).first()[0] or 0) // CHUNK))
    reach = float(np.arccos(threshold)) + 1e-6
    out = None
    for k in range(passes):
        here = placed.filter(F.pmod(F.xxhash64("component", "block"), F.lit(passes)) == k)
        table = here.select("id", "component", "block", "vector").toArrow().to_pydict()  # about CHUNK bytes
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(table["vector"]):
            by_size.setdefault(len(v), []).append(i)
        held = {
            size: Queries([table["id"][i] for i in at], [(table["component"][i], table["block"][i]) for i in at], [table["vector"][i] for i in at])
            for size, at in by_size.items()
        }
        found = stored(nodes.mapInArrow(_comparer(held, threshold, reach), "a long, b long, linked long"), "nn-compared")
        out = found if out is None else out.unionByName(found)
    return out


def _comparer(held: dict[int, Queries], threshold: float, reach: float):
    def run(batches):
        linked = {size: np.zeros(len(q.names), np.int64) for size, q in held.items()}
        root = {size: np.arange(len(q.names)) for size, q in held.items()}
        for batch in batches:
            rows, edges = batch.column("vector").to_pylist(), ([], [])
            every, all_weights = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("id", "weight"))
            for size, q in held.items():
                at = np.array([i for i, r in enumerate(rows) if len(r) == size], np.int64)
                for start in range(0, len(at), BLOCK):
                    part = at[start : start + BLOCK]
                    x, ids, weights = unit([rows[i] for i in part]), every[part], all_weights[part]
                    near = np.arccos(np.clip(x @ q.centres.T, -1, 1)) <= q.radii + reach
                    first = np.full(len(part), -1)
                    for g in np.flatnonzero(near.any(axis=0)):
                        lo, hi = q.spans[g]
                        able = np.flatnonzero(near[:, g])
                        # Groups of more than BLOCK are compared a block at a time.
                        for low in range(lo, hi, BLOCK):
                            i, j = np.nonzero(x[able] @ q.x[low : min(hi, low + BLOCK)].T >= threshold)
                            i, j = able[i], j + low
                            other = ids[i] != q.names[j]
                            i, j = i[other], j[other]
                            if not len(i):
                                continue
                            np.add.at(linked[size], j, weights[i])
                            # A row joins all that it links with: in this block, and with its first link of earlier ones.
                            own, place, times = np.unique(i, return_index=True, return_counts=True)
                            _join(root[size], np.repeat(j[place], times), j)
                            first[own] = np.where(first[own] < 0, j[place], first[own])
                            _join(root[size], first[own], j[place])
                    has = first >= 0
                    edges[0].append(ids[has])
                    edges[1].append(q.names[first[has]])
            if edges[0]:
                a, b = (np.concatenate(side) for side in edges)
                yield _batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(np.zeros(len(a), np.int64))})
        for size, q in held.items():
            has = np.flatnonzero(linked[size])
            a, b = q.names[has], q.names[root[size][has]]
            yield _batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(linked[size][has])})

    return run


def linked_exactly(nodes: DataFrame, links: DataFrame, full: DataFrame | None, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, component) of the linked nodes, and (id, linked) of those compared with all nodes: those of components that
    hold one of ``full`` (a), all if ``full`` is None. What a comparison brings into such a component is compared next."""
    links = links.select("a", "b")
    component = stored(connected_components(links, "nn-components"), "nn-component")
    counted = nodes.limit(0).select("id", F.col("weight").alias("linked"))
    while True:
        members = component.select(F.col("node").alias("id"), "component")
        if full is None:
            # Nodes without a link yet are blocks of their own.
            members = nodes.select("id").join(members, "id", "left").select("id", F.coalesce("component", F.lit(-1 << 63)).alias("component"))
        else:
            held = members.join(full, F.col("id") == F.col("a"), "left_semi").select("component").distinct()
            members = members.join(held, "component")
        members = stored(members.select("id", "component").join(counted, "id", "left_anti"), "nn-members")
        if members.isEmpty():
            return component, counted
        found = compare(nodes, members, threshold)
        links = links.unionByName(found.filter("a <> b").select("a", "b"))
        sums = found.groupBy(F.col("a").alias("id")).agg(F.sum("linked").alias("linked"))
        now = members.select("id").join(sums, "id", "left").select("id", F.coalesce("linked", F.lit(0)).alias("linked"))
        counted = stored(counted.unionByName(now), "nn-counted")
        component = stored(connected_components(links, "nn-components"), "nn-component")


def near_embeddings(embeddings: DataFrame, threshold: float = THRESHOLD, length: int = NEIGHBOURS) -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id = component_id) of every row.

    Two vectors are linked when their cosine, in double precision, is at least ``threshold``; labels and other columns are
    ignored. A vector that is NULL, empty, zero, or holds NULL or non-finite components links with nothing, and so
    do vectors of different lengths. Rows that share a vec_id are one vector; each row is returned. A row without vec_id
    links with nothing, its component_id is NULL and it is kept. An empty table gives no rows.
    """
    found = stored(valid_vectors(embeddings), "nn-vectors")
    # Equal vectors are one node, named by the smallest id, with their number as its weight.
    classes = found.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    nodes = stored(classes.select("id", "weight", "vector"), "nn-nodes")
    graph, length, _, reliable = neighbour_graph(nodes.select("id", "vector"), threshold, length)
    links = graph.filter(F.col("similarity") >= threshold)
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links, "nn-links")
    full = stored(saturated_nodes(graph, threshold, length), "nn-full") if reliable else None
    component, counted = linked_exactly(nodes, links, full, threshold)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    listed = both.join(nodes.select(F.col("id").alias("b"), "weight"), "b").groupBy("a").agg(F.sum("weight").alias("listed"))
    of_class = nodes.select("id", "weight", "vector").join(component.withColumnRenamed("node", "id"), "id", "left")
    of_class = of_class.join(listed.withColumnRenamed("a", "id"), "id", "left").join(counted, "id", "left")
    others = F.coalesce("linked", "listed", F.lit(0)) + F.col("weight") - 1
    of_class = of_class.select("vector", others.cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    of_vector = found.join(of_class, "vector").select(F.col("vec_id").alias("own_id"), "n_links", "component_id")
    rows = embeddings.select(F.col("vec_id").cast("long")).join(of_vector, F.col("vec_id") == F.col("own_id"), "left")
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
