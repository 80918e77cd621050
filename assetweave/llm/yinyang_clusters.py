"""Centroid clustering with Yinyang bounds, exact in integers.

Centroids are dealt into groups once.  Every vector keeps an upper bound on the distance to its own centroid and one lower bound
for each group on the distance to the group's other centroids.  In a round the bounds move by how far centroids moved; a vector whose
upper bound is below all its lower bounds keeps its centroid (global filter), else its distance is measured and the groups whose
lower bound is not above it (group filter) are scanned exactly.  Filters ask for more than rounding could make up, so that a tie is
always scanned; distances that decide are integers.

Vectors and bounds are a table that each round reads and writes, without a shuffle; the driver holds the centroids only (k times dims
numbers).  New centroids come from sums of the vectors that changed their cluster, added up in each task first.

Defined results: vectors with a null, another length or a component that is null or not finite are left out; a null id counts as empty
text when centroids are drawn; repeated rows are vectors of their own; with fewer vectors than centroids each is one; equal hashes
go by the components; components beyond 2**26 after scaling are an error, as squared distances must fit a long; an empty table
gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, materialise

DIMS, K, ROUNDS, PER_GROUP, SCALE = 64, 40, 5, 10, 256
LARGEST, FLOATS_TO = 1 << 26, 1 << 22
STATE = "vec_id long, x binary, cluster int, was int, ub double, lb binary, scans int, distance long"
NAMES = STATE.replace(",", "").split()[::2]
TYPES = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.int32(), pa.int64()]


def is_kept(embedding: Column, dims: int = DIMS) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(embedding) == dims) & F.forall(embedding.cast("array<double>"), finite), F.lit(False))


def integers(values: np.ndarray) -> np.ndarray:
    """floor(scale * x) of doubles."""
    x = np.floor(values.astype(np.float64) * SCALE)
    if x.size and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling: squared distances would not fit a long")
    return x.astype(np.int64)


def groups_of(centroids: np.ndarray, per_group: int = PER_GROUP, rounds: int = 5) -> np.ndarray:
    """The group of each centroid, by a few rounds of clustering of the centroids; fixed afterwards."""
    n = max(1, -(-len(centroids) // per_group))
    means = centroids[:n].astype(np.float64)
    for _ in range(rounds):
        group = ((centroids[:, None, :] - means[None]) ** 2).sum(2).argmin(1)
        for g in range(n):
            if (group == g).any():
                means[g] = centroids[group == g].mean(0)
    return group


class Round:
    """What the tasks of a round need: centroids, their groups, and how far they moved since the round before."""

    def __init__(self, centroids: np.ndarray, group: np.ndarray, before: np.ndarray | None = None):
        self.c, self.members = centroids, [np.flatnonzero(group == g) for g in range(group.max() + 1)]
        self.group = group
        moved = np.zeros(len(centroids)) if before is None else np.sqrt(((centroids - before) ** 2).sum(1).astype(np.float64))
        self.moved = moved * (1 + 1e-9)
        self.group_moved = np.array([self.moved[m].max(initial=0) for m in self.members])

    def distances(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances, exact: in doubles while all sums stay below 2**53, else in integers."""
        c = self.c[ids]
        kind = np.float64 if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < FLOATS_TO else np.int64
        x, c = x.astype(kind), c.astype(kind)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]).astype(np.int64)

    def own(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return ((x - self.c[cluster]) ** 2).sum(1)

    def assign(self, x: np.ndarray, cluster: np.ndarray, ub: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """New clusters and bounds, and how many groups were scanned for each vector.  ``cluster`` -1: not assigned before."""
        n, t = len(x), len(self.members)
        new = cluster < 0
        ub = np.where(new, np.inf, ub + self.moved[cluster])
        lb = np.where(new[:, None], -np.inf, lb - self.group_moved)
        slack = lambda u: 1e-6 * (1 + u)
        with np.errstate(invalid="ignore"):
            near = np.flatnonzero(new | (lb.min(1) <= ub + slack(ub)))
        best, out = np.full(n, np.iinfo(np.int64).max), cluster.copy()
        old = near[~new[near]]
        best[old] = self.own(x[old], cluster[old])
        ub[old] = np.sqrt(best[old].astype(np.float64))
        scans = np.zeros(n, np.int32)
        found = {}
        for g, ids in enumerate(self.members):
            if not len(ids):
                continue
            rows = near[new[near] | (lb[near, g] <= ub[near] + slack(np.where(new[near], 0, ub[near])))]
            if not len(rows):
                continue
            d = self.distances(x[rows], ids)
            first = d.argmin(1)
            least = d[np.arange(len(rows)), first]
            d[np.arange(len(rows)), first] = np.iinfo(np.int64).max
            found[g] = rows, ids[first], least, d.min(1)
            better = (least < best[rows]) | (least == best[rows]) & (ids[first] < out[rows])
            best[rows[better]], out[rows[better]] = least[better], ids[first][better]
            scans[rows] += 1
        # The centroid that was left is one of its group's others now.
        left = old[out[old] != cluster[old]]
        g_left = self.group[cluster[left]]
        lb[left, g_left] = np.minimum(lb[left, g_left], ub[left])
        for g, (rows, first, least, second) in found.items():
            other = np.where(out[rows] == first, second, least)
            lb[rows, g] = np.where(other == np.iinfo(np.int64).max, np.inf, np.sqrt(other.astype(np.float64)))
        ub[near] = np.sqrt(best[near].astype(np.float64))
        return out, ub, lb, scans


def _start(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = integers(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)).astype("<i4")
            n = len(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), *[pa.array(np.full(n, v), t) for v, t in ((-1, pa.int32()), (-1, pa.int32()), (0.0, pa.float64()))], pa.array([b""] * n, pa.binary()), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n, np.int64))], NAMES)

    return run


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def _assign(r: Round, dims: int, last: bool):
    t = len(r.members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, cluster = _vectors(b.column(1), dims), b.column(2).to_numpy()
            lb = np.frombuffer(b"".join(b.column(5).to_pylist()), "<f8").reshape(-1, t) if cluster[0] >= 0 else np.zeros((len(x), t))
            out, ub, lb, scans = r.assign(x, cluster, b.column(4).to_numpy(), lb)
            distance = r.own(x, out) if last else np.zeros(len(x), np.int64)
            cells = [b.column(0), b.column(1), out, cluster, ub, [row.tobytes() for row in lb], b.column(6).to_numpy() + scans, distance]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cells, TYPES)], NAMES)

    return run


def _changes(dims: int):
    """For each batch and cluster what the vectors that came add to its count and sums, less those that left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(0), dims)
            x = np.column_stack([np.ones(len(x), np.int64), x])
            for column, sign in ((b.column(1).to_numpy(), 1), (b.column(2).to_numpy(), -1)):
                ids = np.unique(column[column >= 0])
                if len(ids):
                    sums = np.array([sign * x[column == c].sum(0) for c in ids])
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), *[pa.array(sums[:, i]) for i in range(dims + 1)]], ["cluster", *[f"s{i}" for i in range(dims + 1)]])

    return run


def initial_centroids(kept: DataFrame, k: int = K, seed: int = 2) -> np.ndarray:
    """The integers of the ``k`` vectors with the smallest hash of seed and id (k rows come to the driver)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    return integers(np.array([r["embedding"] for r in rows], np.float64)) if rows else np.empty((0, 0), np.int64)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, per_group: int = PER_GROUP) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance: squared, scans: groups that were scanned for it in all rounds) of the kept vectors, and the centroids."""
    kept = vectors.where(is_kept(F.col("embedding"), dims)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = initial_centroids(kept, k)
    state = kept.mapInArrow(_start(dims), STATE)
    if not len(centroids):
        return state.select("vec_id", "cluster", "distance", "scans"), centroids
    group = groups_of(centroids, per_group)
    before, table = None, None
    totals = np.zeros((len(centroids), dims + 1), np.int64)
    for i in range(rounds + 1):
        state = materialise(state.mapInArrow(_assign(Round(centroids, group, before), dims, i == rounds), STATE), "clusters")
        if table is not None:
            drop_tables(table)
        table = state
        if i == rounds:
            break
        sums = ", ".join(f"s{j} long" for j in range(dims + 1))
        changed = state.where("cluster <> was").select("x", "cluster", "was").mapInArrow(_changes(dims), f"cluster int, {sums}")
        for row in changed.groupBy("cluster").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(dims + 1)]).collect():  # a row for each centroid at most
            totals[row["cluster"]] += np.array(row[1:], np.int64)
        before, full = centroids, totals[:, 0] > 0
        centroids = centroids.copy()
        centroids[full] = totals[full, 1:] // totals[full, :1]
    return state.select("vec_id", "cluster", "distance", "scans"), centroids


def clusters_with_inertia(vectors: DataFrame, **how) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and scans."""
    spark = vectors.sparkSession
    assigned, centroids = cluster(vectors, **how)
    inertia = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()} if len(centroids) else {}  # a row for each centroid at most
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(i, inertia[i], sum(inertia.values()), names[i]) for i in sorted(inertia)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")
