"""Exact Lloyd clustering with bounds over the history of the centroids (ns-bounds).

Every vector keeps an upper bound on the distance to its own centroid and a lower bound for each
other one, each with the round in which it was an exact distance. In a later round a bound is
loosened by the norm of that centroid's total displacement since its round, which the retained
history of centroids gives. That is never more than the sum of the drifts of the rounds
in between, as a centroid that returns costs nothing. If a lower bound does not lie clearly
above the upper one, the distance to the vector's own centroid is made exact, and then the
distances to those centroids that still fail; both in whole numbers, so ties go to the smaller
number and the result equals that of a full search. Rounding of the bounds is covered by a margin.

A round is one pass without a shuffle: Arrow batches of the vectors, with their bounds, go in and come out,
and are written. Sums of the clusters leave every task as one row for each cluster and
component. What reaches the driver, and goes to the tasks in the closure, are the
centroids of all rounds: clusters x components x rounds numbers, whatever the table's size.

Defined cases: vectors that are null, of another length, or hold null or non-finite components
take no part; a component is floor(scale * x), held within +-2^27 so that every squared distance
fits a long; rows that share an id are vectors of their own, and a null id counts as the
text ``null`` where starting centroids are drawn; of equal hashes the smaller vector starts first;
with fewer vectors than clusters each is a centroid; a cluster that loses all vectors keeps its
centroid; an empty table gives an empty result; sums beyond a long are null; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch

MOST = 1 << 27
# Covers the rounding of roots and sums of bounds, relative and absolute.
MARGIN = 1e-9
STATE = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.int32())),
                   ("cluster", pa.int32()), ("upper", pa.float64()), ("upper_round", pa.int16()),
                   ("lower", pa.list_(pa.float64())), ("lower_round", pa.list_(pa.int16())),
                   ("evaluated", pa.int64())])
STATE_DDL = ("vec_id bigint, vector array<int>, cluster int, upper double, upper_round smallint, "
             "lower array<double>, lower_round array<smallint>, evaluated bigint")
REPORT_DDL = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
              "centroid_sha256 string, evaluated bigint")


def whole_vectors(rows: DataFrame, dim: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, vector) of the usable rows, components as whole numbers."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    unit = F.transform(x, lambda v: F.least(F.lit(float(MOST)), F.greatest(
        F.lit(-float(MOST)), F.floor(v * scale).cast("double"))).cast("int"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where((F.size("embedding") == dim) & finite).select("vec_id", unit.alias("vector"))


def starting(vectors: DataFrame, clusters: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    first = vectors.select(F.sha2(name, 256).alias("hash"), "vector").orderBy("hash", "vector").limit(clusters)
    return np.array([r.vector for r in sorted(first.collect())], np.int64)


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, exact."""
    gap = left - right
    return np.einsum("ij,ij->i", gap, gap)


class History:
    """The centroids of all rounds, and how far each one lies from its place in every round."""

    def __init__(self, rounds: list[np.ndarray]) -> None:
        self.now, self.round = rounds[-1], len(rounds) - 1
        with np.errstate(over="ignore"):
            self.moved = np.stack([np.sqrt(squared(old, self.now).astype(np.float64)) for old in rounds])

    def loosened(self, upper, upper_round, cluster, lower, lower_round):
        """Bounds that hold for the centroids of now."""
        up = upper + self.moved[upper_round, cluster]
        low = lower - self.moved[lower_round, np.arange(len(self.now))[None, :]]
        low[np.arange(len(cluster)), cluster] = np.inf
        return up, low


def fails(up: np.ndarray, low: np.ndarray) -> np.ndarray:
    return low <= up[:, None] * (1 + MARGIN) + MARGIN


def assign(x: np.ndarray, state: dict[str, np.ndarray], history: History) -> None:
    """Moves the vectors to their nearest centroids; ``state`` changes in place."""
    cluster, now = state["cluster"], history.now
    up, low = history.loosened(state["upper"], state["upper_round"], cluster, state["lower"],
                               state["lower_round"])
    doubt = np.flatnonzero(fails(up, low).any(axis=1))
    if not len(doubt):
        return
    own = squared(x[doubt], now[cluster[doubt]])
    state["upper"][doubt], state["upper_round"][doubt] = np.sqrt(own), history.round
    state["evaluated"][doubt] += 1
    at, other = np.nonzero(fails(state["upper"][doubt], low[doubt]))
    exact = squared(x[doubt[at]], now[other])
    state["lower"][doubt[at], other] = np.sqrt(exact)
    state["lower_round"][doubt[at], other] = history.round
    np.add.at(state["evaluated"], doubt[at], 1)
    # pairs in order of distance, then number: the first of each vector is its nearest
    order = np.lexsort((other, exact, at))
    first = order[np.unique(at[order], return_index=True)[1]]
    row, best, number = at[first], exact[first], other[first]
    old = cluster[doubt[row]]
    nearer = (best < own[row]) | ((best == own[row]) & (number < old))
    row, best, number, old = row[nearer], best[nearer], number[nearer], old[nearer]
    moved = doubt[row]
    state["lower"][moved, old], state["lower_round"][moved, old] = np.sqrt(own[row]), history.round
    state["upper"][moved], state["upper_round"][moved] = np.sqrt(best), history.round
    cluster[moved] = number


def matrix(column: pa.Array, rows: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1)


def first_search(x: np.ndarray, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """Exact distances to all centroids as the bounds to start with."""
    far = np.stack([squared(x, c[None, :]) for c in centroids], axis=1)
    cluster = far.argmin(axis=1).astype(np.int32)
    root = np.sqrt(far)
    return {"cluster": cluster, "upper": root[np.arange(len(x)), cluster],
            "upper_round": np.zeros(len(x), np.int16), "lower": root,
            "lower_round": np.zeros(far.shape, np.int16),
            "evaluated": np.full(len(x), len(centroids), np.int64)}


def one_round(rounds: list[np.ndarray]):
    """A pass over vectors (in the first round) or their states."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = History(rounds)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = batch["vector"]
            x = matrix(vectors, n, np.int64)
            if len(rounds) == 1:
                state = first_search(x, history.now)
            else:
                state = {name: batch[name].to_numpy().copy()
                         for name in ("cluster", "upper", "upper_round", "evaluated")}
                state["lower"] = matrix(batch["lower"], n, np.float64)
                state["lower_round"] = matrix(batch["lower_round"], n, np.int16)
                assign(x, state, history)
            k = len(history.now)
            starts = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
            lists = {name: pa.ListArray.from_arrays(starts, pa.array(state[name].ravel()))
                     for name in ("lower", "lower_round")}
            columns = {"vec_id": batch["vec_id"], "vector": vectors} | lists
            yield pa.record_batch([columns[f.name] if f.name in columns
                                   else pa.array(state[f.name]) for f in STATE], schema=STATE)

    return run


def part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's sums, one row per cluster and component."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        x = matrix(batch["vector"], batch.num_rows, np.int64)
        cluster = batch["cluster"].to_numpy()
        for c in np.unique(cluster).tolist():
            rows = x[cluster == c]
            sums[c] = sums.get(c, 0) + np.append(rows.sum(axis=0), len(rows))
    rows = [(c, i, int(v)) for c, total in sums.items() for i, v in enumerate(total)]
    yield pa.record_batch([pa.array([r[n] for r in rows], kind) for n, kind in
                           enumerate((pa.int32(), pa.int32(), pa.int64()))],
                          names=["cluster", "component", "total"])


def means(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floor of the clusters' means; empty clusters keep their centroid."""
    parts = state.select("cluster", "vector").mapInArrow(
        part_sums, "cluster int, component int, total bigint")
    totals = parts.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    by_cluster: dict[int, dict[int, int]] = {}
    for r in totals:
        by_cluster.setdefault(r.cluster, {})[r.component] = int(r.total)
    new, dim = old.copy(), old.shape[1]
    for c, total in by_cluster.items():
        new[c] = [total[i] // total[dim] for i in range(dim)]
    return new


def cluster(vectors: DataFrame, scratch: Scratch, clusters: int = 16, rounds: int = 3
            ) -> tuple[DataFrame, np.ndarray]:
    """The vectors' states after ``rounds`` rounds and a last assignment, and the final centroids."""
    first = starting(vectors, clusters)
    if not len(first):
        return vectors.sparkSession.createDataFrame([], STATE_DDL), first
    history, state = [first], vectors
    for at in range(rounds + 1):
        state = scratch.keep(state.mapInArrow(one_round(list(history)), STATE_DDL), f"round-{at}")
        if at:
            scratch.drop(f"round-{at - 1}")
        if at < rounds:
            history.append(means(state, history[-1]))
    return state, history[-1]


def report(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, evaluated)."""
    if not len(centroids):
        return state.sparkSession.createDataFrame([], REPORT_DDL)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = F.array(*[F.array(*map(F.lit, c)) for c in centroids.tolist()])
    gap = F.zip_with("vector", table[F.col("cluster")],
                     lambda a, b: (a - b).cast("long") * (a - b).cast("long"))
    far = state.select("vec_id", "cluster", F.aggregate(
        gap, F.lit(0).cast("long"), lambda total, v: total + v).alias("distance"), "evaluated")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r.cluster: int(r.total) for r in far.groupBy("cluster").agg(total.alias("total")).collect()}
    whole = lambda v: F.lit(v if v < 1 << 63 else None).cast("long")
    by_cluster = F.array(*[whole(sums.get(c, 0)) for c in range(len(names))])
    return far.select(
        "vec_id", "cluster", "distance", by_cluster[F.col("cluster")].alias("cluster_inertia"),
        whole(sum(sums.values())).alias("inertia"),
        F.array(*map(F.lit, names))[F.col("cluster")].alias("centroid_sha256"), "evaluated")
