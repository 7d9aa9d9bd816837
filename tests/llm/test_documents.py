"""The Jaccard join, the mix, and the pipeline."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import graph, jaccard, mixing
from tests.llm.fixtures import DOC_SCHEMA, SF_DIR, SMALL, no_docs, odd_docs, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def brute_components(docs, threshold=90):
    sets = [shingles(t) for _, t, _, _ in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both and 100 * both >= threshold * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    out = []
    for i, (doc_id, *_rest) in enumerate(docs):
        known = [d for d in groups[find(i)] if d is not None]
        out.append((doc_id, len(sets[i]), min(known, default=None)))
    return sorted(out, key=repr)


def near_copies(seed=0):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=40)
    docs, number = [], 0
    for length in (3, 4, 9, 10, 11, 12, 19, 20, 25, 60, 61, 200, 201, 700):
        for _ in range(3):
            base = draw.choices(vocabulary, k=length)
            if length > 60:
                base[20:60] = passage
            for edits in (0, 0, 1, 1, 2, length // 60, length // 30, length // 15):
                words = list(base)
                for _ in range(edits):
                    at = draw.randrange(len(words))
                    words[at:at + 1] = draw.choice([[], [draw.choice(vocabulary)], words[at:at + 1] * 2])
                text = draw.choice([" ", "\n", "  "]).join(words)
                docs.append((number, draw.choice([text, text.upper()]), "en", "s"))
                number += 1
    hot = draw.choices(vocabulary, k=120)
    for _ in range(60):
        words = list(hot)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(120)] = draw.choice(vocabulary)
        docs.append((number, " ".join(words), "en", "s"))
        number += 1
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("page", [512, 7])
def test_components_equal_brute_force(spark, monkeypatch, page):
    monkeypatch.setattr(jaccard, "PAGE_SETS", page)
    docs = near_copies()
    got = jaccard.near_duplicates(spark.createDataFrame(docs, DOC_SCHEMA).repartition(4))
    assert rows(got) == brute_components(docs)


def test_linked_sets_always_share_a_key():
    draw = np.random.default_rng(0)
    for _ in range(400):
        size = int(draw.integers(1, 400))
        base = draw.integers(0, 1 << 63, size).astype(np.uint64)
        larger = int(draw.integers(0, size // 9 + 1))
        other = np.concatenate([base, draw.integers(0, 1 << 63, larger).astype(np.uint64)])
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        assert 190 * both >= 90 * (len(a) + len(b))
        starts = np.array([0, len(a), len(a) + len(b)])
        keys, owner = jaccard.group_keys(np.concatenate([a, b]), starts, 90)
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_the_tree_bounds_from_above():
    draw = np.random.default_rng(2)
    points = draw.poisson(3, (300, jaccard.GROUPS))
    tree = jaccard.CountTree(points, points.sum(1))
    found = {i: set(j.tolist()) for i, j in tree.pairs(tree, 90)}
    for i in range(300):
        bound = np.minimum(points, points[i]).sum(1)
        near = 190 * bound >= 90 * (points[i].sum() + points.sum(1))
        assert set(np.flatnonzero(near).tolist()) <= found.get(i, set())


def test_thresholds_that_lose_no_link():
    """From the least threshold on, a linked pair of any two sizes shares a key."""
    draw = np.random.default_rng(4)
    for threshold in (67, 75, 80):
        for small in range(1, 60):
            large = small * 100 // threshold
            if not large or 100 * small < threshold * large:
                continue
            both = draw.integers(0, 1 << 63, large).astype(np.uint64)
            a, b = np.unique(both[:small]), np.unique(both)
            starts = np.array([0, len(a), len(a) + len(b)])
            keys, owner = jaccard.group_keys(np.concatenate([a, b]), starts, threshold)
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_thresholds_that_could_lose_links_are_refused(spark):
    with pytest.raises(ValueError):
        jaccard.near_duplicates(no_docs(spark), 66)


def test_rows_without_ids_leave_one_of_their_group(spark):
    text, alone = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    given = [(None, text), (None, text), (4, text), (3, text), (None, alone), (None, alone), (None, "x y z"), (9, "q")]
    docs = spark.createDataFrame([(*d, "en", "s") for d in given], DOC_SCHEMA)
    kept = corpus_pipeline.one_of_each(spark, docs, SMALL).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(3, text), (None, alone), (None, "x y z"), (9, "q")], key=repr)


def test_odd_documents_in_the_join(spark):
    docs = [tuple(r) for r in odd_docs(spark).select("doc_id", "text", "lang", "source").collect()]
    assert rows(jaccard.near_duplicates(odd_docs(spark))) == brute_components(docs)
    assert jaccard.near_duplicates(no_docs(spark)).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    edges += [(draw.randrange(2000, 2100), draw.randrange(2000, 2100)) for _ in range(80)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(got) == sorted(((x, find(x)) for x in linked), key=repr)


# --- the mix -----------------------------------------------------------------------


def filled(sizes, weights, share=1.5, most=2):
    """Targets by sharing out again and again, as the rule says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("weights", [(3, 1, 2), (1,), (9, 1)])
def test_targets_and_takings(spark, weights):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 > 0, F.col("source")).when(F.col("doc_id") % 2 == 0, "src1")
    )
    got = mixing.mix_sizes(docs, weights).collect()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    want = filled(sizes, weights)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + 1
    texts = {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.size for r in got} == texts
    assert rows(mixing.mix_sizes(docs.repartition(5), weights)) == rows(mixing.mix_sizes(docs, weights))


def test_odd_documents_in_the_mix(spark):
    got = mixing.mix_sizes(odd_docs(spark))
    assert got.count() == 12
    assert {r["size"] for r in got.filter("doc_id in (1, 2, 3)").collect()} == {0}
    both = got.filter("doc_id = 5").collect()
    assert len(both) == 2 and abs(both[0].copies - both[1].copies) <= 1
    drawn = mixing.mixed_documents(odd_docs(spark))
    assert drawn.columns == odd_docs(spark).columns
    assert drawn.count() == sum(r.copies for r in got.collect())
    assert mixing.mix_sizes(no_docs(spark)).collect() == []
    assert mixing.mixed_documents(no_docs(spark)).collect() == []
    wordless = odd_docs(spark).filter("doc_id in (1, 2, 3)")
    assert {r.copies for r in mixing.mix_sizes(wordless).collect()} == {0}
    with pytest.raises(ValueError):
        mixing.mix_sizes(odd_docs(spark), weights=())


@pytest.mark.parametrize("texts", ["one", "many"])
def test_copies_are_dealt_to_rows_that_share_an_id(spark, texts):
    """A third of the rows has a null id and one size, in the same text or in many."""
    docs = [(None, "w " * 9 + (f"v{i}" if texts == "many" else "v"), "en", "hot") for i in range(300)]
    docs += [(i, "w " * (i % 7 + 1), "en", "hot") for i in range(300)]
    docs += [(1000 + i, "w " * (i % 5 + 1), "en", "b" if i % 2 else None) for i in range(300)]
    given = spark.createDataFrame(docs, DOC_SCHEMA).repartition(4)
    got = mixing.mix_sizes(given).collect()
    sizes, taken, want = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        want[r.source] = r.target
        assert 0 <= r.copies <= 2
    assert len(got) == 900 and want == pytest.approx(filled(sizes, mixing.WEIGHTS), rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 11
    # The very rule, row by row: a row has as many copies as whole numbers its share passes.
    for s in sizes:
        listed = sorted((r for r in got if r.source == s), key=lambda r: (r.size, r.doc_id is not None, r.doc_id))
        start = int(hashlib.md5((s or "\0").encode()).hexdigest()[:8], 16) / 2**32
        e = want[s] / sizes[s]
        passes = [math.floor(i * e + start) for i in range(len(listed) + 1)]
        by_unit, expected = Counter(), Counter()
        for i, r in enumerate(listed):
            by_unit[r.size, r.doc_id] += r.copies
            expected[r.size, r.doc_id] += passes[i + 1] - passes[i]
        assert by_unit == expected
    drawn = [tuple(r) for r in mixing.mixed_documents(given).collect()]
    assert set(drawn) <= set(docs)
    per_unit = Counter((d[0], d[3], len(d[1].split())) for d in drawn)
    assert per_unit == +sum((Counter({(r.doc_id, r.source, r.size): r.copies}) for r in got), Counter())
    most = Counter(docs)
    assert all(n <= 2 * most[d] for d, n in Counter(drawn).items())
    again = mixing.mixed_documents(given.repartition(7))
    assert sorted(map(repr, drawn)) == sorted(repr(tuple(r)) for r in again.collect())


# --- the pipeline ------------------------------------------------------------------


def test_every_stage_keeps_its_promise(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        after = Counter(r.doc_id for r in docs.collect())
        gone = set(before) - set(after)
        if name == "quality":
            good = [d for d in before if labels.get(d) == 1]
            assert gone and sum(d in gone for d in good) <= 0.03 * len(good)
        if name == "language":
            assert len(gone) <= 0.03 * len(before)
        if name == "near_duplicates":
            kept = {d for d, _, c in brute_components([(r.doc_id, r.text, "", "") for r in before.values()]) if d == c}
            assert set(after) == kept
        if name == "mixing":
            assert max(after.values()) <= 2 and set(after) <= set(before)
        before = {d: r for d, r in before.items() if d in after}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    copies = Counter(r.doc_id for r in packed if r.piece == 0)
    assert copies == after


def test_the_pipeline_bears_odd_tables(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert labels.count()
    docs = odd_docs(spark)
    for given in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            given = corpus_pipeline.written(stage(spark, given, SMALL), "test-odd")
            assert given.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, given, SMALL).collect()
