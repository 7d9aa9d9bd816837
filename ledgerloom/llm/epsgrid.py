"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors whose cosine is at least a threshold are no farther apart than some
epsilon. Vectors are sorted by the cells of a grid of that width over their leading
principal dimensions and cut into intervals; pairs of intervals are followed down a
tree, and those whose boxes are farther apart than epsilon are skipped. What is left is
joined by halving intervals in the same way and comparing small blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ranked_within, written
from ledgerloom.llm.graph import components

COSINE = 0.9
DIMENSIONS = 6
# Vectors from which the principal dimensions are taken.
AXIS_SAMPLE = 8192
INTERVAL = 4096
BLOCK = 512
FANOUT = 16
# Cosines this close to the threshold in single precision are computed again in double.
DOUBT = 1e-4


def unit_matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, short ones filled up, and which rows have one."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(int(lengths.max(initial=1)), 1)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    with np.errstate(invalid="ignore"):
        largest = np.abs(out).max(1)
        sound = np.isfinite(largest) & (largest > 0)
    out[~sound] = 0
    out[sound] /= largest[sound, None]
    out[sound] /= np.linalg.norm(out[sound], axis=1, keepdims=True)
    return out, sound


def _widened(matrix: np.ndarray, size: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, size - matrix.shape[1]))) if matrix.shape[1] < size else matrix


def principal_axes(sample: np.ndarray, number: int) -> np.ndarray:
    """Orthonormal columns along which the sample spreads most."""
    if not len(sample):
        return np.eye(sample.shape[1])[:, :number]
    _, axes = np.linalg.eigh(np.cov(sample.T, bias=True).reshape(sample.shape[1], -1))
    return axes[:, ::-1][:, :number]


def block_links(
    left: np.ndarray, right: np.ndarray, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both sides whose cosine reaches the threshold, decided in double precision."""
    rough = left.astype(np.float32) @ right.astype(np.float32).T
    i, j = np.nonzero(rough >= cosine - DOUBT)
    doubtful = rough[i, j] < cosine + DOUBT
    keep = np.ones(len(i), bool)
    at = np.flatnonzero(doubtful)
    for first in range(0, len(at), 1 << 16):
        some = at[first:first + (1 << 16)]
        keep[some] = np.einsum("ij,ij->i", left[i[some]], right[j[some]]) >= cosine
    return i[keep], j[keep]


def interval_links(
    left: np.ndarray,
    right: np.ndarray,
    axes: np.ndarray,
    cosine: float,
    same: bool,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two intervals, halved until small; distant halves are skipped.

    With ``same`` the intervals are one, and only pairs with i < j come out.
    """
    limit = 2 - 2 * cosine + 1e-9
    a_place, b_place = left @ axes, right @ axes

    def walk(a: int, b: int, c: int, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if same and c < a:
            return
        gap = np.maximum(
            b_place[c:d].min(0) - a_place[a:b].max(0), a_place[a:b].min(0) - b_place[c:d].max(0)
        )
        gap = np.maximum(gap, 0)
        if float(gap @ gap) > limit:
            return
        if b - a <= BLOCK and d - c <= BLOCK:
            i, j = block_links(left[a:b], right[c:d], cosine)
            i, j = i + a, j + c
            if same:
                ahead = i < j
                i, j = i[ahead], j[ahead]
            if len(i):
                yield i, j
            return
        middle, other = (a + b) // 2, (c + d) // 2
        if b - a > BLOCK and d - c > BLOCK:
            parts = [(a, middle, c, other), (a, middle, other, d), (middle, b, c, other), (middle, b, other, d)]
        elif b - a > BLOCK:
            parts = [(a, middle, c, d), (middle, b, c, d)]
        else:
            parts = [(a, b, c, other), (a, b, other, d)]
        for part in parts:
            yield from walk(*part)

    if len(left) and len(right):
        yield from walk(0, len(left), 0, len(right))


def joining(i: np.ndarray, j: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links out of (i, j) that join what ``label`` holds apart, no more than needed.

    Each round links every higher label to one lower one, so links never form a ring.
    """
    chosen: list[tuple[int, int]] = []
    while True:
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        apart = low != high
        if not apart.any():
            return chosen
        i, j, low, high = i[apart], j[apart], low[apart], high[apart]
        tops, at = np.unique(high, return_index=True)
        chosen.extend(zip(i[at].tolist(), j[at].tolist(), strict=True))
        parent = np.arange(len(label))
        parent[tops] = low[at]
        while True:
            further = parent[parent]
            if np.array_equal(further, parent):
                break
            parent = further
        label[:] = parent[label]


_OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _tile_links(pairs: DataFrame, axes, cosine: float) -> DataFrame:
    """For pairs of intervals: rows (a, null, links) of counts and (a, b, null) of links.

    Counts cover every link; of the links themselves only as many as join what they
    connect, so a tile gives at most two rows per vector however dense it is.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(k)[r] for k, n in enumerate(batch.schema.names)}
                same = row["interval"].as_py() == row["other"].as_py()
                size = axes.value.shape[0]
                left = _widened(unit_matrix(row["vectors"].values)[0], size)
                right = left if same else _widened(unit_matrix(row["other_vectors"].values)[0], size)
                ids, weights = (np.asarray(row[n].values) for n in ("ids", "weights"))
                more, more_weights = (
                    (ids, weights) if same else
                    (np.asarray(row[n].values) for n in ("other_ids", "other_weights"))
                )
                count = np.zeros(len(ids), np.int64)
                other = count if same else np.zeros(len(more), np.int64)
                shift = 0 if same else len(ids)
                label = np.arange(len(ids) + (0 if same else len(more)))
                chosen: list[tuple[int, int]] = []
                for i, j in interval_links(left, right, axes.value, cosine, same):
                    count += np.bincount(i, more_weights[j], minlength=len(count)).astype(np.int64)
                    other += np.bincount(j, weights[i], minlength=len(other)).astype(np.int64)
                    chosen += joining(i, j + shift, label)
                names = ids if same else np.concatenate([ids, more])
                counts = count if same else np.concatenate([count, other])
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([names[some], names[[a for a, _ in chosen]]]).astype(np.int64)),
                        pa.concat_arrays(
                            [pa.nulls(len(some), pa.int64()), pa.array(names[[b for _, b in chosen]].astype(np.int64))]
                        ),
                        pa.concat_arrays([pa.array(counts[some]), pa.nulls(len(chosen), pa.int64())]),
                    ],
                    schema=_OUT,
                )

    return pairs.mapInArrow(compare, "a long, b long, links long")


def _near_boxes(boxes: DataFrame, cosine: float) -> DataFrame:
    """Pairs of intervals whose boxes are within reach, from the whole sequence downwards.

    ``boxes`` has a row per interval. Intervals are gathered ``FANOUT`` at a time into
    longer ones until one is left; a pair's parts are looked at only if it is in reach.
    """
    limit = 2 - 2 * cosine + 1e-9
    levels = [boxes.select(F.col("interval").alias("at"), "low", "high")]
    number = (boxes.agg(F.max("interval")).first()[0] or 0) + 1
    dims = range(DIMENSIONS)
    while number > 1:
        below = levels[-1]
        up = below.groupBy(F.floor(F.col("at") / FANOUT).alias("at")).agg(
            F.array(*[F.min(F.get("low", F.lit(d))) for d in dims]).alias("low"),
            F.array(*[F.max(F.get("high", F.lit(d))) for d in dims]).alias("high"),
        )
        levels.append(written(up, "grid-boxes"))
        number = -(-number // FANOUT)
    pairs = levels[-1].select(F.col("at").alias("a"), F.col("at").alias("b"))
    for level in reversed(levels[:-1]):
        parent = F.floor(F.col("at") / FANOUT)
        first = level.select(parent.alias("up_a"), F.col("at").alias("of_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
        second = level.select(parent.alias("up_b"), F.col("at").alias("of_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
        gap = F.zip_with(
            F.zip_with("low_b", "high_a", lambda x, y: x - y),
            F.zip_with("low_a", "high_b", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        )
        apart = F.aggregate(gap, F.lit(0.0), lambda total, g: total + g * g)
        pairs = written(
            pairs.join(first, F.col("a") == F.col("up_a"))
            .join(second, F.col("b") == F.col("up_b"))
            .filter((F.col("of_a") <= F.col("of_b")) & (apart <= limit))
            .select(F.col("of_a").alias("a"), F.col("of_b").alias("b")),
            "grid-pairs",
        )
    return pairs


def near_vectors(df: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``df``.

    Takes ``vec_id`` and ``embedding``; other columns are ignored. Rows link when the
    cosine of their vectors is at least ``cosine``; null and zero vectors and those
    that hold null or non-finite components link with nothing. Vectors of different
    length meet as if filled up with zeros. Equal vectors are compared once and counted
    as often as they occur. ``component_id`` is the smallest id reachable, null ids
    aside; ``kept`` is false for a null id. Repeated rows are rows of their own, linked
    with each other. No rows give no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    distinct = written(
        rows.filter(F.col("embedding").isNotNull()).groupBy("embedding").agg(F.count(F.lit(1)).alias("weight")),
        "grid-vectors",
    )
    size = distinct.agg(F.max(F.size("embedding"))).first()[0] or 1
    sample = distinct.orderBy(F.xxhash64("embedding")).limit(AXIS_SAMPLE).select("embedding").toArrow()
    units, sound = unit_matrix(sample.column(0))
    chosen = principal_axes(_widened(units, size)[sound], DIMENSIONS)
    chosen = np.pad(chosen, ((0, 0), (0, DIMENSIONS - chosen.shape[1])))
    axes = spark.sparkContext.broadcast(chosen)
    width = float(np.sqrt(2 - 2 * cosine))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, sound = unit_matrix(batch.column(0))
            at = (_widened(units, axes.value.shape[0]) @ axes.value)[sound]
            cells = np.floor(at / width).astype(np.int32)
            kept = batch.filter(pa.array(sound))
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column(0), kept.column(1),
                    pa.array(list(at), pa.list_(pa.float64())), pa.array(list(cells), pa.list_(pa.int32())),
                ],
                names=["embedding", "weight", "place", "cell"],
            )

    kind = distinct.schema["embedding"].dataType.simpleString()
    placed = distinct.mapInArrow(
        place, f"embedding {kind}, weight long, place array<double>, cell array<int>"
    ).withColumn("all", F.lit(0))
    ordered = written(
        ranked_within(placed, "all", ["cell", "place"], "grid-order").select(
            (F.col("row_rank") - 1).alias("id"), "embedding", "weight", "place",
            F.floor((F.col("row_rank") - 1) / INTERVAL).alias("interval"),
        ),
        "grid-ordered",
    )
    dims = range(DIMENSIONS)
    boxes = written(
        ordered.groupBy("interval").agg(
            F.array(*[F.min(F.get("place", F.lit(d))) for d in dims]).alias("low"),
            F.array(*[F.max(F.get("place", F.lit(d))) for d in dims]).alias("high"),
        ),
        "grid-boxes",
    )
    pairs = _near_boxes(boxes, cosine)
    # An interval holds INTERVAL vectors at most.
    content = written(
        ordered.groupBy("interval").agg(F.collect_list(F.struct("id", "weight", "embedding")).alias("held")),
        "grid-intervals",
    ).select(
        "interval", F.col("held.id").alias("ids"), F.col("held.weight").alias("weights"),
        F.col("held.embedding").alias("vectors"),
    )
    other = content.select(
        F.col("interval").alias("other"), F.col("ids").alias("other_ids"),
        F.col("weights").alias("other_weights"), F.col("vectors").alias("other_vectors"),
    )
    tiles = pairs.join(content, F.col("a") == F.col("interval")).join(other, F.col("b") == F.col("other"))
    found = written(_tile_links(tiles.drop("a", "b"), axes, cosine), "grid-links")
    counts = found.filter("links is not null").groupBy(F.col("a").alias("counted")).agg(
        F.sum("links").alias("links")
    )
    label = components(found.filter("links is null").select("a", "b"))
    named = ordered.join(counts, F.col("id") == F.col("counted"), "left").join(
        label, F.col("id") == F.col("node"), "left"
    ).select(
        F.col("embedding").alias("of_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component"),
    )
    same = F.col("embedding") == F.col("of_vector")
    labelled = written(
        rows.join(named, same, "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component"),
        "grid-labels",
    )
    smallest = labelled.filter("component is not null").groupBy(F.col("component").alias("of")).agg(
        F.min("vec_id").alias("smallest")
    )
    return labelled.join(smallest, F.col("component") == F.col("of"), "left").select(
        "vec_id",
        "n_links",
        F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("smallest")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
