"""Exact top-k search by inner product in an M-tree of pages.

The tree has the pivots of a bounded sample at its root, pages of bounded size below
them, and nodes of a few dozen vectors in every page. Pages and nodes carry their
covering radius, and pages, nodes and vectors the distance to their parent's routing
vector. With |q - x| at least what the triangle inequality says, the product of q and x
is at most (|q|^2 + |x|^2 - that^2) / 2: nodes and vectors are skipped by stored
distances alone where this stays below a query's worst result, and computed otherwise.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import written

SCALE = 1024
PIVOTS = 32
# Vectors among which the pivots are chosen.
PIVOT_SAMPLE = 4096
PAGE_VECTORS = 4096
NODE_VECTORS = 64
QUERY_BLOCK = 256
# Bounds are widened by this share against rounding.
SLACK = 1e-9


def whole_vectors(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``: scale * x of every component x, floored when read as a matrix.

    Vectors that are null or hold null or non-finite components are left out, as are
    those that overflow a double.
    """
    scaled = F.transform(
        F.col("embedding").cast("array<double>"), lambda v: v * F.lit(float(scale))
    )
    sound = F.forall(
        F.col("vector"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("vector"))
    return rows.filter(F.col("vector").isNotNull() & sound)


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of whole numbers as doubles; short vectors are filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), float)
    out = np.zeros((len(lengths), max(size, 1)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column] = np.floor(values)
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def products(a: np.ndarray, q: np.ndarray) -> list[int]:
    """Exact inner products of whole-number rows with one vector, held to 64 bits."""
    limit = float(np.abs(a).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(len(q), 1)
    if limit < 2.0**53:
        return (a @ q).astype(np.int64).tolist()
    wide = [int(v) for v in q]
    exact = [sum(int(x) * y for x, y in zip(row, wide, strict=True)) for row in a]
    return [min(max(v, -(1 << 63)), (1 << 63) - 1) for v in exact]


def choose_pivots(sample: np.ndarray, number: int) -> np.ndarray:
    """Vectors far from each other: each the farthest from those before it."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(number, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


class Page:
    """Nodes under one pivot: the M-tree's lower levels, built for a page of vectors."""

    def __init__(self, pivot: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        number = -(-len(vectors) // NODE_VECTORS)
        seeds = choose_pivots(vectors, number)
        to_seed = distances(vectors, seeds)
        node = to_seed.argmin(1)
        order = np.argsort(node, kind="stable")
        self.pivot = pivot
        self.ids, self.vectors = ids[order], vectors[order]
        self.to_parent = to_seed[order, node[order]]
        self.norms = (self.vectors * self.vectors).sum(1)
        self.cuts = np.searchsorted(node[order], np.arange(len(seeds) + 1))
        self.seeds = seeds
        self.to_pivot = distances(seeds, pivot[None])[:, 0]
        self.radius = np.array([self._most(self.to_parent, i) for i in range(len(seeds))])
        self.norm = np.array([self._most(self.norms, i) for i in range(len(seeds))])

    def _most(self, values: np.ndarray, node: int) -> float:
        return float(values[self.cuts[node]:self.cuts[node + 1]].max(initial=0))

    def search(
        self, query_id: int, q: np.ndarray, k: int, worst: float
    ) -> tuple[list[tuple[int, int]], int]:
        """The page's best ``k`` at least as good as ``worst``, and how many products it took.

        A queue holds nodes by what they can give at most: first by stored distances,
        then, when such a node comes up, by its own distance, then it is opened.
        """
        square = float(q @ q)
        slack = SLACK * (square + float(self.norms.max(initial=0))) + 1e-6
        at_pivot = float(distances(q[None], self.pivot[None])[0, 0])
        apart = np.maximum(np.abs(at_pivot - self.to_pivot) - self.radius, 0)
        most = (square + self.norm - apart**2) / 2 + slack
        queue = [(-m, False, i, 0.0) for i, m in enumerate(most.tolist()) if m >= worst]
        heapq.heapify(queue)
        best: list[tuple[int, int]] = []
        computed = 0
        while queue:
            bound, exact, node, at_seed = heapq.heappop(queue)
            if -bound < worst:
                break
            if not exact:
                at_seed = float(np.linalg.norm(q - self.seeds[node]))
                apart_node = max(at_seed - self.radius[node], 0)
                bound = -((square + self.norm[node] - apart_node**2) / 2 + slack)
                heapq.heappush(queue, (bound, True, node, at_seed))
                continue
            a, b = self.cuts[node], self.cuts[node + 1]
            near = np.abs(at_seed - self.to_parent[a:b])
            fit = a + np.flatnonzero((square + self.norms[a:b] - near**2) / 2 + slack >= worst)
            computed += len(fit)
            for vec_id, product in zip(self.ids[fit].tolist(), products(self.vectors[fit], q), strict=True):
                if vec_id != query_id and product >= worst:
                    best.append((-product, vec_id))
            best.sort(key=lambda e: (e[0], e[1] is None, e[1] or 0))
            del best[k:]
            if len(best) == k:
                worst = max(worst, -best[-1][0])
        return [(-p, i) for p, i in best], computed


_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "query long, vec_id long, score long"


def _search_pages(pages: DataFrame, visits: DataFrame, pivots, k: int) -> DataFrame:
    """Each page in one task, with the queries that visit it passing by as a stream."""
    both = pages.select(
        "page", F.lit(False).alias("visit"), "pivot", F.col("vec_id").alias("id"), "vector",
        F.lit(None).cast("long").alias("query"), F.lit(None).cast("long").alias("worst"),
    ).unionByName(
        visits.select(
            "page", F.lit(True).alias("visit"), F.lit(None).cast("int").alias("pivot"),
            F.col("query_id").alias("id"), "vector", "query", "worst",
        )
    )
    size = pivots.value.shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, page = None, None
        ids: list[pa.Array] = []
        rows: list[np.ndarray] = []
        pivot = 0
        for batch in batches:
            found: list[tuple] = []
            pages_of = np.asarray(batch.column(0))
            visit = np.asarray(batch.column(1))
            vectors = matrix(batch.column(4), size)
            cut = np.flatnonzero(
                np.concatenate([[True], (pages_of[1:] != pages_of[:-1]) | (visit[1:] != visit[:-1])])
            )
            for a, b in zip(cut, [*cut[1:], batch.num_rows], strict=True):
                if pages_of[a] != name:
                    name, page, ids, rows = pages_of[a], None, [], []
                if not visit[a]:
                    ids.append(batch.column(3).slice(a, b - a))
                    rows.append(vectors[a:b])
                    pivot = batch.column(2)[int(a)].as_py()
                    continue
                if not rows:
                    continue
                if page is None:
                    known = np.array([i for part in ids for i in part.to_pylist()], object)
                    page = Page(pivots.value[pivot], known, np.concatenate(rows))
                for r in range(a, b):
                    worst = batch.column(6)[r].as_py()
                    best, _ = page.search(
                        batch.column(3)[r].as_py(), vectors[r], k, -np.inf if worst is None else worst
                    )
                    query = batch.column(5)[r].as_py()
                    found.extend((query, vec_id, score) for score, vec_id in best)
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], schema=_FOUND
            )

    return (
        both.repartition("page").sortWithinPartitions("page", "visit")
        .select("page", "visit", "pivot", "id", "vector", "query", "worst")
        .mapInArrow(search, _FOUND_DDL)
    )


def _nearest(rows: DataFrame, pivots) -> DataFrame:
    """Rows with their nearest ``pivot`` and the distance to it, ``reach``."""
    size = pivots.value.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(1), size)
            away = distances(vectors, pivots.value)
            norms = (vectors * vectors).sum(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(away.argmin(1).astype(np.int32)),
                    pa.array(away.min(1)), pa.array(norms),
                ],
                names=["vec_id", "vector", "pivot", "reach", "norm"],
            )

    return rows.mapInArrow(
        assign, "vec_id long, vector array<double>, pivot int, reach double, norm double"
    )


def top_products(df: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best rows for every query row.

    ``is_query`` (on ``vec_id``) names the queries; candidates are all rows but those
    with the query's own id. Ties go to the smaller id, nulls last. Vectors that are
    null or hold null or non-finite components take no part; vectors of different
    length meet as if filled up with zeros. Equal queries of one id are one query; ids
    repeated with other vectors are queries of their own. A product beyond 64 bits is
    held to the largest of them. No rows give no rows.
    """
    spark = df.sparkSession
    rows = written(whole_vectors(df, scale), "mtree-vectors")
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    sample = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(PIVOT_SAMPLE).select("vector").toArrow()
    chosen = choose_pivots(matrix(sample.column(0), longest), PIVOTS)
    pivots = spark.sparkContext.broadcast(chosen)
    placed = written(_nearest(rows, pivots), "mtree-placed")
    # One row per pivot: bounded, whatever the table's size.
    cells = placed.groupBy("pivot").agg(
        F.ceil(F.count(F.lit(1)) / PAGE_VECTORS).alias("pages"),
        F.max("reach").alias("radius"),
        F.max("norm").alias("norm"),
    ).toArrow().to_pandas().sort_values("pivot")
    cells["first"] = cells["pages"].cumsum() - cells["pages"]
    known = spark.createDataFrame(cells[["pivot", "pages", "first"]].astype("int64"), "cell long, pages long, first long")
    pages = placed.join(F.broadcast(known), F.col("pivot") == F.col("cell")).select(
        "vec_id", "vector", "pivot",
        (F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("pages"))).alias("page"),
    )
    queries = written(
        placed.filter(is_query).select(F.col("vec_id").alias("query_id"), "vector", "pivot").distinct()
        .withColumn("query", F.monotonically_increasing_id()),
        "mtree-queries",
    )
    # First the pages nearest to each query, for a bound; then all that can beat it.
    home = queries.join(F.broadcast(known), F.col("pivot") == F.col("cell")).select(
        "query", "query_id", "vector", F.col("first").alias("page"), F.lit(None).cast("long").alias("worst")
    )
    seeds = _search_pages(pages, home, pivots, k)
    worst = seeds.groupBy(F.col("query").alias("_query")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("worst")
    )
    bounded = queries.join(worst, F.col("query") == F.col("_query"), "left")
    visits = _cells_to_visit(bounded, pivots, cells)
    found = _search_pages(pages, visits, pivots, k)
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    ids = queries.select(F.col("query").alias("_query"), "query_id")
    return best.join(ids, F.col("query") == F.col("_query")).select("query_id", "rank", "vec_id", "score")


def _cells_to_visit(queries: DataFrame, pivots, cells) -> DataFrame:
    """A row for every page of every pivot whose vectors may reach a query's bound."""
    size = pivots.value.shape[1]
    cell = cells["pivot"].to_numpy()
    radius, norm = cells["radius"].to_numpy(), cells["norm"].to_numpy()
    first, number = cells["first"].to_numpy(), cells["pages"].to_numpy()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(2), size)
            square = (vectors * vectors).sum(1)[:, None]
            apart = np.maximum(distances(vectors, pivots.value[cell]) - radius, 0)
            most = (square + norm - apart**2) / 2
            most += SLACK * (square + norm) + 1e-6
            worst = np.array([-np.inf if w is None else w for w in batch.column(3).to_pylist()])
            row, at = np.nonzero(most >= worst[:, None])
            for begin in range(0, len(row), QUERY_BLOCK):
                some, of = row[begin:begin + QUERY_BLOCK], at[begin:begin + QUERY_BLOCK]
                some = np.repeat(some, number[of])
                page = np.concatenate([np.arange(number[o]) + first[o] for o in of])
                part = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(page.astype(np.int64))],
                    names=["query", "query_id", "vector", "worst", "page"],
                )

    return queries.select("query", "query_id", "vector", "worst").mapInArrow(
        visit, "query long, query_id long, vector array<double>, worst long, page long"
    )
