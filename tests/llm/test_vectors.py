import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import epsgrid, mtree
from tests.llm.fixtures import rows

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [math.nan, 1.0], 0),
    (6, [math.inf, 1.0], 0), (100, [0.5, 0.5], 0), (7, [0.5, 0.5], 0), (7, [0.5, 0.5], 1),
    (None, [0.5, 0.5], 1), (200, [0.25, 0.5, 0.125], None), (8, [-0.5, -0.5], 2), (9, [1e30, -1e30], 2),
]


def frame(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return df.withColumns({n: F.lit("x") for n in ("vector", "pivot", "page", "place", "cell", "id", "weight", "all")})


def clustered(n, seed=0, dims=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (12, dims))
    x = centres[draw.integers(0, 12, n)] + draw.normal(0, 0.25, (n, dims))
    x[n // 2:n // 2 + n // 10] = x[0] + draw.normal(0, 0.01, (n // 10, dims))
    x[-5:] = x[1]
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


# --- top k -------------------------------------------------------------------------


def brute_top(data, k=10, every=100):
    whole = []
    for vec_id, v, _ in data:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for q, v in {(q, tuple(v)) for q, v in whole if q is not None and q % every == 0}:
        scored = sorted(
            ((-sum(a * b for a, b in zip(v, w, strict=False)), c is None, c or 0) for c, w in whole if c != q)
        )
        out += [
            (q, i + 1, None if none else c, min(max(-s, -(2**63)), 2**63 - 1))
            for i, (s, none, c) in enumerate(scored[:k])
        ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("page", [4096, 60])
def test_top_k_equals_brute_force(spark, monkeypatch, page):
    monkeypatch.setattr(mtree, "PAGE_VECTORS", page)
    data = [(i, v.tolist(), 0) for i, v in enumerate(clustered(900))]
    got = mtree.top_products(frame(spark, data), F.col("vec_id") % 100 == 0)
    assert rows(got) == brute_top(data)


def test_odd_vectors_and_ties(spark):
    got = mtree.top_products(frame(spark, ODD), F.col("vec_id") % 100 == 0)
    assert rows(got) == brute_top(ODD)
    assert mtree.top_products(frame(spark, []), F.col("vec_id") % 100 == 0).collect() == []


def test_stored_distances_spare_products():
    x = np.floor(1024 * clustered(3000).astype(float))
    page = mtree.Page(x[0], np.arange(len(x)), x)
    for q in x[::500]:
        best, computed = page.search(-1, q, 10, -np.inf)
        want = sorted(((-int(p), i) for i, p in enumerate(x @ q)))[:10]
        assert best == [(-p, i) for p, i in want]
        assert computed < len(x) / 2


# --- near duplicates -----------------------------------------------------------------


def brute_links(data, cosine=0.9):
    size = max([len(v) for _, v, _ in data if v], default=1)
    units = []
    for _, v, _ in data:
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        u = np.zeros(size)
        if ok:
            u[:len(v)] = np.array(v, np.float32).astype(float)
            u /= np.abs(u).max()
            u /= np.linalg.norm(u)
        units.append(u)
    units = np.array(units)
    linked = (units @ units.T >= cosine)
    np.fill_diagonal(linked, False)
    label = np.arange(len(data))
    for _ in range(len(data)):
        new = np.where(linked, label[None, :], len(data)).min(1)
        new = np.minimum(label, new)
        if (new == label).all():
            break
        label = new
    out = []
    for i, (vec_id, _, _) in enumerate(data):
        ids = [data[j][0] for j in np.flatnonzero(label == label[i]) if data[j][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, int(linked[i].sum()), component, vec_id is not None and vec_id == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("interval", [4096, 50])
def test_links_equal_brute_force(spark, monkeypatch, interval):
    monkeypatch.setattr(epsgrid, "INTERVAL", interval)
    data = [(i * 7 % 1000, v.tolist(), 0) for i, v in enumerate(clustered(700, seed=3))]
    assert rows(epsgrid.near_vectors(frame(spark, data))) == brute_links(data)


def test_odd_vectors_link_with_nothing(spark):
    assert rows(epsgrid.near_vectors(frame(spark, ODD))) == brute_links(ODD)
    assert epsgrid.near_vectors(frame(spark, [])).collect() == []


def test_distant_intervals_are_skipped():
    draw = np.random.default_rng(0)
    x = np.sort(draw.uniform(0, math.pi, 4000))
    units = np.stack([np.cos(x), np.sin(x)], 1)
    found = list(epsgrid.interval_links(units, units, np.eye(2), 0.9, True))
    got = {(a, b) for i, j in found for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    near = np.cos(x[:, None] - x[None, :]) >= 0.9
    assert abs(len(got) - int(np.triu(near, 1).sum())) <= 2
    blocks = len(found)
    assert blocks < (4000 / epsgrid.BLOCK + 1) ** 2 / 2
    label = np.arange(4000)
    chosen = [e for i, j in found for e in epsgrid.joining(i, j, label)]
    assert len(chosen) == 3999 and len(set(label)) == 1
