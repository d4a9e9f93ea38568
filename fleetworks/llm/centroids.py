"""Exact centroid clustering with ns-bounds.

Each vector keeps an upper bound on the distance to its centroid and, for each group of centroids, a lower bound on the
distance to the nearest other one in it, both with the round they were measured in. The centroids of all rounds are
retained, so a bound is loosened by how far its centroid lies from where it was measured (the norm of the sum of its
moves), never by the sum of the norms. A vector whose upper bound stays below all lower bounds keeps its cluster
unseen; otherwise the groups whose bounds fail are scanned again in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetworks.llm.topk import whole_vectors
from fleetworks.session import discard, scratch_dir, settle

SCALE, DIMS, CLUSTERS, ROUNDS, SEED = 256, 64, 40, 5, 2
#: Centroids that share one lower bound.
GROUP = 10
#: Components this large or larger could overflow a squared distance in 64 bits.
TOO_LARGE = 1 << 27
#: Vectors of a batch worked on at once.
LANES = 4096
_SLACK = 1e-9
_BOUNDS = "cluster int, upper double, upper_at int, lower array<double>, lower_at array<int>"


def squared(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids. Floats where every sum fits their 53 bits, else 64-bit integers."""
    reach = float(np.abs(v).max(initial=0)) + float(np.abs(centres).max(initial=0))
    kind = np.float64 if reach * reach * v.shape[1] < 2 ** 52 else np.int64
    a, b = v.astype(kind), centres.astype(kind)
    return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)


def own_squared(v: np.ndarray, centres: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    apart = v - centres[cluster]
    return np.einsum("ij,ij->i", apart, apart)


def groups_of(centres: np.ndarray) -> list[np.ndarray]:
    """Runs of ``GROUP`` centroids along the first axis of their spread, so that those of a group lie near each other."""
    spread = centres - centres.mean(0)
    order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable")
    return [np.sort(order[at:at + GROUP]) for at in range(0, len(order), GROUP)]


class Bounds:
    """Assignment of batches in one round, given the centroids of this and all earlier rounds."""

    def __init__(self, history: list[np.ndarray], groups: list[np.ndarray]):
        self.now, self.centres, self.groups = len(history) - 1, history[-1], groups
        moved = np.stack([np.sqrt(((self.centres - old).astype(float) ** 2).sum(1)) for old in history])
        self.moved = moved * (1 + _SLACK)  # round measured in, centroid
        self.group_moved = np.stack([self.moved[:, g].max(1) for g in groups], axis=1)  # round, group
        self.group_of = np.empty(len(self.centres), int)
        for n, members in enumerate(groups):
            self.group_of[members] = n

    def first(self, v: np.ndarray) -> tuple:
        """All distances: cluster, upper bound and its round, lower bounds and their rounds."""
        d = squared(v, self.centres)
        cluster = d.argmin(1)  # the first of equal ones
        rows = np.arange(len(v))
        upper = np.sqrt(d[rows, cluster])
        rest = np.sqrt(d)
        rest[rows, cluster] = np.inf
        lower = np.stack([rest[:, g].min(1) for g in self.groups], axis=1)
        return cluster, upper, np.full(len(v), self.now), lower, np.full(lower.shape, self.now)

    def again(self, v, cluster, upper, upper_at, lower, lower_at) -> tuple:
        """The same from the bounds of an earlier round. Bounds that hold are handed on as they were measured."""
        cluster, upper, upper_at, lower, lower_at = (a.copy() for a in (cluster, upper, upper_at, lower, lower_at))
        above = upper + self.moved[upper_at, cluster]
        below = lower - self.group_moved[lower_at, np.arange(len(self.groups))[None, :]]
        nearest = below.min(1)
        unsure = np.flatnonzero(~self._clear(above, nearest))
        upper[unsure] = np.sqrt(own_squared(v[unsure], self.centres, cluster[unsure]))
        upper_at[unsure] = self.now
        unsure = unsure[~self._clear(upper[unsure], nearest[unsure])]
        if len(unsure):
            self._rescan(v, unsure, below, cluster, upper, lower, lower_at)
        return cluster, upper, upper_at, lower, lower_at

    @staticmethod
    def _clear(above: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Strictly below, rounding left aside: at a tie the smaller number has to be looked up."""
        return above * (1 + _SLACK) + _SLACK < below

    def _rescan(self, v, unsure, below, cluster, upper, lower, lower_at) -> None:
        old = cluster[unsure]
        scan = ~self._clear(upper[unsure, None], below[unsure])  # vector, group
        best = own_squared(v[unsure], self.centres, old)
        old_squared, winner = best.copy(), old.copy()
        seen = {}
        for n, members in enumerate(self.groups):
            rows = np.flatnonzero(scan[:, n])
            if not len(rows):
                continue
            d = squared(v[unsure[rows]], self.centres[members])
            seen[n] = rows, d
            at = d.argmin(1)  # members ascend, so the first is the smallest number
            least, number = d[np.arange(len(rows)), at], members[at]
            better = (least < best[rows]) | ((least == best[rows]) & (number < winner[rows]))
            best[rows[better]], winner[rows[better]] = least[better], number[better]
        cluster[unsure], upper[unsure] = winner, np.sqrt(best)
        for n, (rows, d) in seen.items():
            rest = np.sqrt(d)
            rest[self.groups[n][None, :] == winner[rows, None]] = np.inf
            lower[unsure[rows], n], lower_at[unsure[rows], n] = rest.min(1), self.now
        # the centroid left behind counts among the others of its group, if that was not scanned
        home = self.group_of[old]
        left = np.flatnonzero((winner != old) & ~scan[np.arange(len(old)), home])
        rows, n = unsure[left], home[left]
        lower[rows, n] = np.minimum(below[rows, n], np.sqrt(old_squared[left]))
        lower_at[rows, n] = self.now


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), kind))


def _assigned(state: DataFrame, shared, dims: int) -> DataFrame:
    """(id, v, cluster, bounds) under the newest centroids of the shared history."""
    known = "cluster" in state.columns
    columns = ["id", "v"] + (["cluster", "upper", "upper_at", "lower", "lower_at"] if known else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(*shared.value)
        width = len(bounds.groups)
        for whole in batches:
            for at in range(0, whole.num_rows, LANES):
                batch = whole.slice(at, LANES)
                v = _matrix(batch.column(1), dims, np.int64)
                if known:
                    flat = [batch.column(i).to_numpy() for i in (2, 3, 4)]
                    got = bounds.again(v, *flat, _matrix(batch.column(5), width, float), _matrix(batch.column(6), width, np.int32))
                else:
                    if np.abs(v).max(initial=0) >= TOO_LARGE:
                        raise OverflowError("a component is too large for squared distances in 64 bits")
                    got = bounds.first(v)
                cluster, upper, upper_at, lower, lower_at = got
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(upper, pa.float64()),
                     pa.array(upper_at, pa.int32()), _lists(lower, pa.float64()), _lists(lower_at, pa.int32())],
                    names=["id", "v", "cluster", "upper", "upper_at", "lower", "lower_at"])

    return state.select(*columns).mapInArrow(run, f"id bigint, v array<bigint>, {_BOUNDS}")


def _means(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """floor(sum / count) of every cluster with vectors; the others stay. A task sends one row per cluster."""
    dims, k = centres.shape[1], len(centres)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster, v = batch.column(0).to_numpy(), _matrix(batch.column(1), dims, np.int64)
            count += np.bincount(cluster, minlength=k)
            for number in np.unique(cluster):
                total[number] += v[cluster == number].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(count), _lists(total, pa.int64())],
                                         names=["cluster", "n", "total"])

    parts = state.select("cluster", "v").mapInArrow(add, "cluster int, n bigint, total array<bigint>")
    sums = parts.select("cluster", "n", F.posexplode("total").alias("at", "x")).groupBy("cluster", "at").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n"))
    out = centres.copy()
    for row in sums.collect():  # clusters * components rows
        if row["n"]:
            out[row["cluster"], row["at"]] = row["x"] // row["n"]
    return out


def _starts(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose ids hash lowest; those of equal ids by their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    picked = vectors.orderBy(order.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return np.array([r["v"] for r in picked], np.int64)


def cluster(table: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per vector: key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors are floor(scale * x) of rows with exactly ``dims`` components, none null or not finite; others take no part.
    The ``clusters`` vectors with the smallest sha256 of ``seed:key`` are the first centroids, all vectors if there are
    fewer; a null key sorts last. Each round assigns every vector to the nearest centroid, the smaller number at a tie,
    and moves each non-empty centroid to the floored mean; after the last round all are assigned once more. Repeated
    rows count each and equal ones may start two centroids, of which the later stays empty. An empty table gives an
    empty result. Components from ``TOO_LARGE`` on fail instead of giving wrong distances.

    Centroids of all rounds are sent to the tasks: clusters * components * (rounds + 1) numbers. Vectors and bounds are
    written anew each round, and the copy of the round before is deleted.
    """
    spark = table.sparkSession
    state = settle(whole_vectors(table, key, vector, scale).where(F.col("dims") == dims).select("id", "v"), "vectors")
    history = [_starts(state, clusters, seed)]
    named = F.col("id").alias(key)
    if not len(history[0]):
        return spark.createDataFrame([], "id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
                                         "centroid_sha256 string").select(named, *_RESULT)
    groups, previous = groups_of(history[0]), None
    for _ in range(rounds + 1):
        shared = spark.sparkContext.broadcast((history, groups))
        path = scratch_dir(spark, "bounds")
        _assigned(state, shared, dims).write.parquet(path)
        shared.unpersist()
        state = spark.read.schema(f"id bigint, v array<bigint>, {_BOUNDS}").parquet(path)
        if previous:
            discard(spark, previous)
        previous = path
        if len(history) <= rounds:
            history.append(_means(state, history[-1]))
    last = history[rounds]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance = own_squared(_matrix(batch.column(1), dims, np.int64), last, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(distance)],
                                             names=["id", "cluster", "distance"])

    measured = settle(state.select("id", "v", "cluster").mapInArrow(measure, "id bigint, cluster int, distance bigint"), "measured")
    discard(spark, previous)
    sums = {r["cluster"]: r["s"] for r in measured.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in last]
    facts = spark.createDataFrame([(n, s, sum(sums.values()), digests[n]) for n, s in sums.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row per cluster
    return measured.join(F.broadcast(facts), "cluster").select(named, *_RESULT)


_RESULT = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
