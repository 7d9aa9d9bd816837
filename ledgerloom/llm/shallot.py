"""Exact centroid clustering (Lloyd's rounds) that compares each vector with few centroids.

A vector remembers its centroid, the second-nearest one, and two bounds: its distance to
the first is at most ``upper``, to every other at least ``lower``. While upper < lower
after the centroids moved, nothing is computed. Otherwise the search starts from the
closer of the two remembered centroids and walks the others in order of their distance
from it. Only centroids within (distance to the start + second-best distance) can come
in, and that ball shrinks whenever a better second is found. Survivors are compared by
squared distances in integers, so ties are exact.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import written
from ledgerloom.sources.zones import shared_scratch

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
# Vectors of a block; a block is a row and no group of vectors is any larger.
BLOCK = 2048
# Components beyond this many steps would not fit squared distances into a long.
LARGEST = 1 << 27
# Bounds are doubles; they are widened by this share, far above their rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class Centroids:
    """Centroids and what the search needs to know of them; made anew each round."""

    points: np.ndarray
    distances: np.ndarray
    order: np.ndarray
    half_gap: np.ndarray

    @staticmethod
    def of(points: np.ndarray) -> Centroids:
        apart = points[:, None, :] - points[None, :, :]
        distances = np.sqrt((apart * apart).sum(2, dtype=np.int64).astype(np.float64))
        away = distances + np.diag(np.full(len(points), np.inf))
        order = np.argsort(away, axis=1, kind="stable")
        return Centroids(points, distances, order, away.min(1) / 2)

    def moved_to(self, new: Centroids) -> np.ndarray:
        step = new.points - self.points
        return np.sqrt((step * step).sum(1, dtype=np.int64).astype(np.float64))


@dataclass
class Bounds:
    """Per vector: its centroid, the remembered second, and the two bounds."""

    near: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    @staticmethod
    def unknown(n: int, k: int) -> Bounds:
        return Bounds(
            np.zeros(n, np.int64), np.full(n, min(1, k - 1), np.int64),
            np.full(n, np.inf), np.zeros(n),
        )

    def follow(self, moves: np.ndarray) -> None:
        """Widen the bounds by how far the centroids moved."""
        most = int(np.argmax(moves))
        others = np.delete(moves, most).max(initial=0.0)
        self.upper = (self.upper + moves[self.near]) * (1 + SLACK)
        farthest = np.where(self.near == most, others, moves[most])
        self.lower = np.maximum(self.lower - farthest * (1 + SLACK), 0.0)


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    apart = vectors.astype(np.int64) - points
    return np.einsum("ij,ij->i", apart, apart)


def assign(vectors: np.ndarray, centroids: Centroids, bounds: Bounds) -> int:
    """Bring ``bounds`` up to date for ``centroids``; returns how many distances that took.

    Ties go to the centroid with the smaller number.
    """
    k = len(centroids.points)
    if k == 1:
        return 0
    gap = np.maximum(bounds.lower, centroids.half_gap[bounds.near] * (1 - SLACK))
    rows = np.flatnonzero(~(bounds.upper < gap))
    near = bounds.near[rows]
    exact = squared(vectors[rows], centroids.points[near])
    computed = len(rows)
    upper = np.sqrt(exact.astype(np.float64)) * (1 + SLACK)
    bounds.upper[rows] = upper
    open_ = ~(upper < gap[rows])
    rows, near, exact = rows[open_], near[open_], exact[open_]
    if not len(rows):
        return computed

    second = bounds.second[rows]
    other = squared(vectors[rows], centroids.points[second])
    computed += len(rows)
    swap = (other < exact) | ((other == exact) & (second < near))
    near, second = np.where(swap, second, near), np.where(swap, near, second)
    exact, other = np.where(swap, other, exact), np.where(swap, exact, other)

    start = near.copy()
    reach = np.sqrt(exact.astype(np.float64))
    walking = np.arange(len(rows))
    for step in range(k - 1):
        candidate = centroids.order[start[walking], step]
        ball = (reach[walking] + np.sqrt(other[walking].astype(np.float64))) * (1 + SLACK)
        inside = centroids.distances[start[walking], candidate] <= ball
        walking, candidate = walking[inside], candidate[inside]
        if not len(walking):
            break
        fresh = (candidate != near[walking]) & (candidate != second[walking])
        at, new = walking[fresh], candidate[fresh]
        d = squared(vectors[rows[at]], centroids.points[new])
        computed += len(at)
        best = (d < exact[at]) | ((d == exact[at]) & (new < near[at]))
        closer = best | (d < other[at])
        second[at] = np.where(best, near[at], np.where(closer, new, second[at]))
        other[at] = np.where(best, exact[at], np.where(closer, d, other[at]))
        near[at] = np.where(best, new, near[at])
        exact[at] = np.where(best, d, exact[at])

    bounds.near[rows], bounds.second[rows] = near, second
    bounds.upper[rows] = np.sqrt(exact.astype(np.float64)) * (1 + SLACK)
    bounds.lower[rows] = np.sqrt(other.astype(np.float64)) * (1 - SLACK)
    return computed


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id`` and ``embedding`` of vectors that are whole and have the right length."""
    sound = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return vectors.select("vec_id", F.col("embedding").cast("array<double>")).filter(
        (F.size("embedding") == dimensions) & sound
    )


def steps(embedding: str, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x))


def first_centroids(kept: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id, as integers, in that order.

    All of them, if there are fewer. At most k rows reach the driver.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = (
        kept.select(F.sha2(name, 256).alias("hash"), steps("embedding", scale).alias("v"))
        .orderBy("hash", "v")
        .limit(k)
        .collect()
    )
    return np.array([r["v"] for r in chosen], np.int64)


_BLOCKS = "block long, ids array<long>, vectors binary"
_STATE = (
    "block long, near binary, second binary, upper binary, lower binary, computed long, "
    "changes array<struct<cluster: int, vectors: long, sums: array<long>>>"
)


def _packed(kept: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """Vectors as integers in blocks, a row each, numbered apart within every task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            task, ids, values = batch.columns
            values = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            whole = np.floor(values * scale)
            if len(whole) and np.abs(whole).max() > LARGEST:
                raise ArithmeticError(
                    f"a component is beyond {LARGEST // scale}: its squared distance fits no long"
                )
            for at in range(0, len(whole), BLOCK):
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [task[at].as_py()],
                        "ids": pa.array([ids.slice(at, BLOCK).to_pylist()], pa.list_(pa.int64())),
                        "vectors": [whole[at:at + BLOCK].astype(np.int32).tobytes()],
                    }
                )

    # A row's own number stands for its block: it is unique over all tasks.
    numbered = kept.select(
        F.monotonically_increasing_id().alias("block"), F.col("vec_id").cast("long"), "embedding"
    )
    return numbered.mapInArrow(pack, _BLOCKS)


class _Blocks:
    """Blocks, and their state of the last round, in tables bucketed by block.

    Both sides of each round's join then lie together already: a round shuffles nothing
    but sums of the vectors that changed centroid. The vectors are written once.
    """

    def __init__(self, blocks: DataFrame) -> None:
        self.spark: SparkSession = blocks.sparkSession
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: list[str] = []
        self.vectors = self._table(blocks.repartition(self.buckets, "block"))

    def _table(self, rows: DataFrame) -> DataFrame:
        name = f"blocks_{uuid.uuid4().hex}"
        self.tables.append(name)
        path = shared_scratch(self.spark, "centroid-blocks")
        writer = rows.write.format("parquet").option("path", path)
        writer.bucketBy(self.buckets, "block").sortBy("block").saveAsTable(name)
        return self.spark.table(name)

    def state(self, rows: DataFrame) -> DataFrame:
        """``rows`` written as the newest state; the name of the one before the last goes."""
        state = self._table(rows)
        while len(self.tables) > 3:
            self._forget(self.tables.pop(1))
        return state

    def close(self) -> None:
        """Forget the names in the catalogue; the files stay until the driver's JVM ends."""
        while self.tables:
            self._forget(self.tables.pop())

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _round(
    vectors: DataFrame, state: DataFrame | None, before: Centroids | None, now: Centroids
) -> DataFrame:
    """State after a round: each block's bounds, and what its changed vectors add and take."""
    k, dimensions = now.points.shape
    joined = vectors.drop("ids")
    if state is not None:
        joined = joined.join(state.drop("changes", "computed"), "block")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["vectors"], np.int32).reshape(-1, dimensions)
                if before is None:
                    bounds, old = Bounds.unknown(len(v), k), None
                else:
                    bounds = _bounds_of(row)
                    old = bounds.near.copy()
                    bounds.follow(before.moved_to(now))
                computed = assign(v, now, bounds)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([row["block"]], pa.int64()),
                        "near": [bounds.near.astype(np.int32).tobytes()],
                        "second": [bounds.second.astype(np.int32).tobytes()],
                        "upper": [bounds.upper.tobytes()],
                        "lower": [bounds.lower.tobytes()],
                        "computed": pa.array([computed], pa.int64()),
                        "changes": pa.array([_changes(v, old, bounds.near, k)], _CHANGES),
                    }
                )

    return joined.mapInArrow(work, _STATE)


_CHANGES = pa.list_(
    pa.struct([("cluster", pa.int32()), ("vectors", pa.int64()), ("sums", pa.list_(pa.int64()))])
)


def _bounds_of(row: dict) -> Bounds:
    return Bounds(
        np.frombuffer(row["near"], np.int32).astype(np.int64),
        np.frombuffer(row["second"], np.int32).astype(np.int64),
        np.frombuffer(row["upper"], np.float64).copy(),
        np.frombuffer(row["lower"], np.float64).copy(),
    )


def _changes(v: np.ndarray, old: np.ndarray | None, new: np.ndarray, k: int) -> list[dict]:
    """Per cluster, the vectors and sums it won less those it lost."""
    moved = np.arange(len(v)) if old is None else np.flatnonzero(old != new)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, v.shape[1]), np.int64)
    for clusters, sign in ((new, 1),) if old is None else ((new, 1), (old, -1)):
        np.add.at(counts, clusters[moved], sign)
        np.add.at(sums, clusters[moved], sign * v[moved].astype(np.int64))
    touched = np.flatnonzero((counts != 0) | (sums != 0).any(1))
    return [
        {"cluster": int(c), "vectors": int(counts[c]), "sums": sums[c].tolist()} for c in touched
    ]


def _add_changes(state: DataFrame, counts: list[int], sums: list[list[int]]) -> None:
    """Bring the clusters' counts and sums, exact whole numbers, up to date.

    A row per cluster and component reaches the driver.
    """
    each = state.select(F.explode("changes").alias("c")).select("c.*")
    parts = each.select("cluster", F.posexplode("sums").alias("i", "part"), "vectors")
    added = parts.groupBy("cluster", "i").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("sum"), F.sum("vectors").alias("n")
    )
    for row in added.collect():
        sums[row["cluster"]][row["i"]] += int(row["sum"])
        if row["i"] == 0:
            counts[row["cluster"]] += row["n"]


_ASSIGNED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()),
    ]
)


def _assigned(vectors: DataFrame, state: DataFrame, last: Centroids) -> DataFrame:
    dimensions = last.points.shape[1]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, near in zip(
                batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                strict=True,
            ):
                v = np.frombuffer(raw, np.int32).reshape(-1, dimensions)
                cluster = np.frombuffer(near, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(cluster), pa.array(squared(v, last.points[cluster]))],
                    names=["vec_id", "cluster", "distance"],
                )

    rows = vectors.join(state.select("block", "near"), "block")
    return rows.select("ids", "vectors", "near").mapInArrow(tell, _ASSIGNED)


def cluster_vectors(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = 2,
    work: list[int] | None = None,
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Components become whole steps of 1 / ``scale``. Each round assigns all vectors to the
    nearest centroid and moves every centroid that has any to the floor of its vectors'
    mean; after the last, they are assigned once more. Sums and distances are exact
    integers, and ties go to the smaller number, so every run gives the same rows.

    Null vectors, vectors of another length, and those with null or non-finite components
    are left out. Repeated rows are vectors of their own; a null id hashes as the empty
    text. With fewer than ``k`` vectors each starts a centroid; equal starts leave the
    later ones empty, where they stay. Components beyond half a million raise. Other
    columns are not read. Without vectors there are no rows. ``work`` receives the number
    of distances of each round.
    """
    if k < 1 or rounds < 0:
        raise ValueError("at least one centroid and no negative number of rounds")
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dimensions)
    points = first_centroids(kept, k, scale, seed)
    if not len(points):
        return spark.createDataFrame([], _RESULT)
    if np.abs(points).max() > LARGEST:
        raise ArithmeticError(f"a component is beyond {LARGEST // scale}")
    blocks = _Blocks(_packed(kept, dimensions, scale))
    try:
        before, now, state = None, Centroids.of(points), None
        counts, sums = [0] * len(points), [[0] * dimensions for _ in points]
        for number in range(rounds + 1):
            state = blocks.state(_round(blocks.vectors, state, before, now))
            if work is not None:
                work.append(int(state.agg(F.sum("computed")).first()[0]))
            if number < rounds:
                _add_changes(state, counts, sums)
                before, now = now, Centroids.of(_means(now.points, counts, sums))
        assigned = written(_assigned(blocks.vectors, state, now), "centroid-clusters")
    finally:
        blocks.close()
    return _described(assigned, now)


def _means(points: np.ndarray, counts: list[int], sums: list[list[int]]) -> np.ndarray:
    return np.array(
        [
            [s // n for s in total] if n else list(point)
            for point, n, total in zip(points, counts, sums, strict=True)
        ],
        np.int64,
    )


_RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid_sha256 string"
)


def _described(assigned: DataFrame, last: Centroids) -> DataFrame:
    """Assignments with what is known of each cluster, a row per centroid, joined on."""
    spark = assigned.sparkSession
    inertia = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")
    ).collect()
    own = {r["cluster"]: int(r["sum"]) for r in inertia}
    whole = sum(own.values())
    listed = [
        (c, own[c], whole, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest())
        for c, p in enumerate(last.points.tolist())
        if c in own
    ]
    told = spark.createDataFrame(
        listed, "of_cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per centroid: as many as the caller asked for.
    joined = assigned.join(F.broadcast(told), F.col("cluster") == F.col("of_cluster"))
    return joined.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
