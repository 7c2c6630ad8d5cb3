"""Whitening of embeddings by their weighted covariance, with copies counted instead of repeated.

Equal vectors are grouped first. The fit gives each distinct vector a weight, its count or one; sums are exact whole numbers, and
every task adds the weighted product of its centred vectors. The eigenvectors of the covariance whiten each distinct
vector once, and the rows get their vector's values by a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored

COMPONENTS = 4
SCALE = 256  # of an entry, before it is rounded down
LARGEST = 2**52  # entries beyond it are as good as infinite: whole numbers near them are no longer exact
HOT = 1_000  # a vector that holds more than one of so many rows is joined by broadcast: there are fewer than HOT of them
BLOCK = 1024  # vectors multiplied at a time


def _packed(vector: np.ndarray) -> bytes:
    """Whole numbers in the least of 2, 4 or 8 bytes that holds them all; equal vectors give equal bytes."""
    least, most = (int(vector.min()), int(vector.max())) if len(vector) else (0, 0)
    for width, kind in ((2, "<i2"), (4, "<i4")):
        if -(1 << (8 * width - 1)) <= least and most < 1 << (8 * width - 1):
            break
    else:
        width, kind = 8, "<i8"
    return bytes([width]) + vector.astype(kind).tobytes()


def _unpacked(key: bytes) -> np.ndarray:
    return np.frombuffer(key, f"<i{key[0]}", offset=1).astype(np.int64)


def whole_vectors(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, size, key): the rows' entries times ``scale``, rounded down, packed as bytes. Rows whose vector is NULL or has an
    entry that is NULL, not finite or beyond LARGEST are left out."""

    def run(batches):
        for batch in batches:
            ids, sizes, keys = [], [], []
            for i, vector in zip(batch.column("id").to_pylist(), batch.column("vector")):
                values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL entries become NaN
                x = np.floor(values * scale)
                if np.isfinite(values).all() and (np.abs(x) <= LARGEST).all():
                    ids.append(i)
                    sizes.append(len(x))
                    keys.append(_packed(x.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary())], ["id", "size", "key"])

    entries = rows.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector")).filter("vector IS NOT NULL")
    return entries.mapInArrow(run, "id long, size int, key binary")


def _blocks(batches, weights: str):
    """(vectors, weights) of a task's rows, BLOCK at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = np.stack([_unpacked(k) for k in part.column("key").to_pylist()])
            yield x, part.column(weights).to_numpy(zero_copy_only=False)


def _sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """The weights' sum and each dimension's weighted sum, exact."""

    def run(batches):
        weight, total = 0, np.zeros(size, object)
        for x, w in _blocks(batches, "weight"):
            weight += int(w.sum())
            if int(np.abs(x).max()) * int(w.sum()) >= 2**63:
                x = x.astype(object)
            total = total + (x * w[:, None]).sum(axis=0).astype(object)
        rows = [str(weight), *(str(t) for t in total)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), pa.array(rows)], ["place", "total"])

    added = distinct.mapInArrow(run, "place int, total string")
    added = added.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r.place: int(r.total) for r in added.collect()}  # one number for each dimension
    return found.get(-1, 0), [found.get(i, 0) for i in range(size)]


def _covariance(rows: DataFrame, size: int, centre: np.ndarray, weight: int, values) -> np.ndarray:
    """The weighted covariance of ``values(batches)``, centred before it is multiplied, divided by the weights' sum.

    A task gives one row for each dimension; the shuffle's partitions, not the input's, set the number of tasks. Rows are added in the
    tasks' order, so a task that runs again changes no digit.
    """

    def run(batches):
        product = np.zeros((size, size))
        for x, w in values(batches):
            centred = x - centre
            product += (centred * w[:, None]).T @ centred
        task = TaskContext.get().partitionId()
        rows = pa.array(list(product), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([task] * size, pa.int32()), rows], ["place", "task", "part"])

    def add(table):
        table = table.sort_by("task")
        total = np.zeros(size)
        for part in table.column("part").to_pylist():
            total += np.array(part)
        return pa.table({"place": table.column("place")[:1], "total": pa.array([total], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "place int, task int, part array<double>")
    added = parts.groupBy("place").applyInArrow(add, "place int, total array<double>").collect()  # size x size numbers
    out = np.zeros((size, size))
    for r in added:
        out[r.place] = r.total
    return (out + out.T) / (2 * weight)


def whiten(
    rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS, weights: str = "one", scale: int = SCALE
) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: up to ``components`` rows for each vector.

    A vector's entries become whole numbers x (entry times ``scale``, rounded down). The fit has each distinct x once, with weight one
    (``weights`` "one") or its number of rows ("count"); n is the weights' sum, S the weighted sum of x. ``deviation`` is the sum over
    the dimensions of (n x - S)^2, exact, NULL where it does not fit a long. Components are numbered from 1 by falling
    variance; ``whitened`` is x - S / n on the component's unit eigenvector (its largest entry positive) divided by its deviation, ``explained`` the
    component's share of the total variance, ``identity_error`` the largest entry, without its sign, of the whitened fit's covariance minus
    the identity. A component without variance has whitened NULL and explained 0 (NULL if nothing varies) and is left
    out of identity_error, which is NULL if none is left.

    Left out: rows whose vector is NULL, holds a NULL, non-finite or too large entry, and those of another length than the most
    common one (ties: the longer); of empty vectors there is no component. Repeated rows and NULL ids are rows like others; other columns are ignored;
    an empty table gives no rows.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    spark = rows.sparkSession
    whole = stored(whole_vectors(rows, id_column, column, scale), "white-rows")
    fields = f"{id_column} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = whole.groupBy("size").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    if common is None or common["size"] == 0:
        return spark.createDataFrame([], fields)
    size, total = common["size"], common["rows"]
    whole = whole.filter(F.col("size") == size).select("id", "key")
    distinct = whole.groupBy("key").agg(F.count("*").alias("copies"))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    distinct = stored(distinct.withColumn("weight", weight), "white-distinct")

    n, sums = _sums(distinct, size)
    centre = np.array([s / n for s in sums])
    covariance = _covariance(distinct, size, centre, n, lambda batches: _blocks(batches, "weight"))
    variance, vectors = np.linalg.eigh(covariance)
    variance, vectors = variance[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], axis=0) < 0, -1.0, 1.0)
    shown = len(variance)
    varies = variance > max(variance[0], 0) * size * np.finfo(float).eps * 4
    factors = vectors / np.sqrt(np.where(varies, variance, 1.0))
    spread = max(int(abs(s)) for s in sums)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = np.stack([_unpacked(k) for k in part.column("key").to_pylist()])
                values = (x - centre) @ factors
                largest = int(np.abs(x).max()) * n + spread
                if largest * largest * size < 2**63:
                    apart = n * x - np.array(sums, np.int64)
                    deviation = (apart * apart).sum(axis=1).tolist()
                else:
                    deviation = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]
                    deviation = [d if d < 2**63 else None for d in deviation]
                columns = [part.column(c) for c in ("key", "copies", "weight")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(deviation, pa.int64()), pa.array(list(values), pa.list_(pa.float64()))],
                    ["key", "copies", "weight", "deviation", "whitened"],
                )

    made = distinct.mapInArrow(run, "key binary, copies long, weight long, deviation long, whitened array<double>")
    made = stored(made, "white-vectors")

    def values(batches):
        for batch in batches:
            if batch.num_rows:
                yield np.stack(batch.column("whitened").to_numpy(zero_copy_only=False)), batch.column("weight").to_numpy(zero_copy_only=False)

    error = None
    if varies.any():
        means = made.select(*(F.sum(F.col("whitened")[i] * F.col("weight")) / n for i in range(shown))).first()
        checked = _covariance(made.select("whitened", "weight"), shown, np.array(means), n, values)
        error = float(np.abs((checked - np.eye(shown))[np.ix_(varies, varies)]).max())

    # Join back. A vector's copies stay where they are if it is a hot one: those are few, whatever the input.
    hot = F.col("copies") * HOT > total
    few = made.filter(hot).select("key", "deviation", "whitened")
    rest = made.filter(~hot).select("key", "deviation", "whitened")
    answered = whole.join(F.broadcast(few), "key", "left")
    done = answered.filter("whitened IS NOT NULL").select("id", "deviation", "whitened")
    late = answered.filter("whitened IS NULL").select("id", "key").join(rest, "key").select("id", "deviation", "whitened")
    every = done.unionByName(late)

    def listed(values):
        return F.array(*(F.lit(v).cast("double") for v in values))

    trace = np.trace(covariance)
    shares = listed([float(e / trace) if v else 0.0 for e, v in zip(variance, varies)] if varies.any() else [None] * shown)
    held = listed([1.0 if v else None for v in varies])
    each = every.select("id", "deviation", "whitened", F.posexplode(held).alias("i", "varies"))
    return each.select(
        F.col("id").alias(id_column), (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        (F.get("whitened", F.col("i")) * F.col("varies")).alias("whitened"), F.get(shares, F.col("i")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
