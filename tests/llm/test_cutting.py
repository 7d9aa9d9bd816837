"""Fill-in-middle, the rule ledger and centroid clustering, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import fim, ledger, shallot
from tests.llm.fixtures import LONG, DOC_SCHEMA, SF_DIR, no_docs, odd_docs, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- fill-in-middle ----------------------------------------------------------


def numbers(doc_id, seed=1):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * i:8 * i + 8], 16) for i in range(4)]


def units_of(text, unit):
    if unit == "char":
        return list(text)
    if unit == "line":
        return text.splitlines(keepends=True) if "\r" not in text else None
    first = re.match(r"[\x20\x09-\x0D]*", text).group()
    parts = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
    # White space in front is a unit of its own.
    return [first, *parts] if first else parts


def plain_fim(doc_id, text, unit="char", transformed=90, suffix_first=20):
    text = text or ""
    parts = units_of(text, unit)
    n = len(parts)
    h = numbers(doc_id)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= transformed:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < suffix_first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_docs(spark):
    draw = random.Random(3)
    letters = "aé漢\U0001f600 \n\tz"
    texts = ["".join(draw.choices(letters, k=k)) for k in (1, 2, 63, 64, 255, 256, 257, 512, 5000)]
    texts += ["keeps <S> a mark", "almost <S < P> <M", "<", "a" * 256, "é" * 128, "<P>"]
    texts += ["\\Q.*\\E$1", "<<P>>", "x" * 700_000]
    listed = [(100 + i, t, "en", "s") for i, t in enumerate(texts * 3)]
    return odd_docs(spark).select("doc_id", "text", "lang", "source").unionByName(
        spark.createDataFrame(listed, DOC_SCHEMA)
    )


@pytest.mark.parametrize("unit", fim.UNITS)
def test_fim_equals_plain_cutting_and_is_restored(spark, unit):
    docs = fim_docs(spark)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = fim.fill_in_middle(docs, unit=unit).withColumn(
        "back", fim.restored(F.col("output"), F.col("form"))
    )
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = sorted(((*plain_fim(i, t, unit), t or "") for i, t in given), key=repr)
    assert got == want
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_fim_settings_and_no_rows(spark):
    assert fim.fill_in_middle(no_docs(spark)).collect() == []
    docs = fim_docs(spark)
    assert {r["form"] for r in fim.fill_in_middle(docs, transformed=0).collect()} == {"plain"}
    marks = fim.Marks("[[prefix]]", "[[suffix]]", "[[middle]]")
    turned = fim.fill_in_middle(docs, transformed=100, suffix_first=100, marks=marks)
    text = fim.restored(F.col("output"), F.col("form"), marks).alias("text")
    assert rows(turned.select("doc_id", text)) == rows(
        docs.select("doc_id", F.coalesce("text", F.lit("")))
    )
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, unit="page")


@pytest.mark.parametrize("marks", [("", "b", "c"), ("ab", "b", "c"), ("aba", "x", "y"), ("ab", "bc", "d")])
def test_fim_refuses_marks_that_split_in_two_ways(marks):
    with pytest.raises(ValueError):
        fim.Marks(*marks)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100])
def test_fenwick_sums_and_descends(n):
    counts = np.random.default_rng(n).integers(0, 4, n)
    tree, sums = fim.fenwick(counts), np.concatenate([[0], np.cumsum(counts)])
    assert fim.sum_before(tree, np.arange(n + 1)).tolist() == sums.tolist()
    wanted = np.arange(sums[-1])
    block, skip = fim.block_of(tree, wanted)
    assert block.tolist() == (np.searchsorted(sums, wanted, "right") - 1).tolist()
    assert (sums[block] + skip).tolist() == wanted.tolist()


# --- the rule ledger ---------------------------------------------------------


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    letters = [c for c in text if c.isalpha()]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_letters": len(letters),
        "n_upper": sum(c.isupper() for c in letters),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words),
        "n_stutter": sum(a == b for a, b in zip(words, words[1:], strict=False)),
    }


def ledger_docs(spark):
    draw = random.Random(5)
    texts = [
        " ".join(draw.choices("ab", k=k)) for k in (4, 5, 6, 7, 9, 10, 11, 30, 200)
    ] + [" ".join(draw.choices([f"w{i}" for i in range(9)], k=k)) for k in (20, 60, 300, 3000)]
    texts += [
        "one two\none two\n one two\n\n \none two", "a b c d e a b c d e", "a b c d e f a b c d e",
        "x\r\nx\r\n", "CAPS ONLY, HERE!! AND MORE OF IT TO MAKE TEN WORDS", "*** ### $$$ %%% | < >",
        "\x0bverti\x0ccal\x0b tabs", "ünï ÜNÏ 漢字 \U0001f600 é", "a " * 5000, "12 34 56 78 90 1 2 3 4 5 6",
    ]
    return odd_docs(spark).select("doc_id", "text", "lang", "source", "n", "size").unionByName(
        spark.createDataFrame(
            [(200 + i, t, "en", "s", "x", "x") for i, t in enumerate(texts)],
            DOC_SCHEMA + ", n string, size string",
        )
    )


def test_ledger_measures_equal_plain_ones(spark):
    docs = ledger_docs(spark)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = ledger.rule_ledger(docs)
    want = sorted(((i, *plain_measures(t).values()) for i, t in given), key=repr)
    assert got.columns == ["doc_id", *ledger.MEASURES, "failed"]
    assert rows(got.drop("failed")) == want


def plain_failures(text):
    m = plain_measures(text)
    return {
        r.name for r in ledger.RULES
        if eval(r.fails.replace(" AND ", " and ").replace(" OR ", " or "), {}, m)  # noqa: S307
    }


def test_verdicts_and_ablations_equal_plain_ones(spark):
    docs = ledger_docs(spark)
    failing = [plain_failures(r["text"]) for r in docs.collect()]
    held = ledger.rule_ledger(docs)
    lenient = ledger.Policy("lenient", tuple(r.name for r in ledger.RULES[1:]), tolerated=1)
    policies = (*ledger.POLICIES, lenient)

    def kept(fails, policy, left_out=()):
        return len((fails & set(policy.rules)) - set(left_out)) <= policy.tolerated

    for policy in policies:
        got = Counter(r["kept"] for r in ledger.with_verdict(held, policy).collect())
        assert got == Counter(kept(f, policy) for f in failing)
    want = [
        (
            p.version, r, len(failing), sum(kept(f, p) for f in failing),
            sum(r in f for f in failing), sum(kept(f, p, [r]) for f in failing),
            sum(kept(f, p, [r]) and not kept(f, p) for f in failing),
        )
        for p in policies
        for r in p.rules
    ]
    assert rows(ledger.ablations(held, policies)) == sorted(want, key=repr)
    assert any(row[-1] for row in want)


def test_ledger_without_rows_and_with_odd_policies(spark):
    held = ledger.rule_ledger(no_docs(spark))
    assert held.collect() == [] and ledger.ablations(held).collect() == []
    with pytest.raises(ValueError):
        ledger.Policy("p", ("no such rule",)).mask()
    with pytest.raises(ValueError):
        ledger.failure_bits([ledger.Rule(f"r{i}", "n_words < 1") for i in range(64)])


def test_ledger_runs_without_python_or_shuffle(spark):
    held = ledger.with_verdict(ledger.rule_ledger(spark.read.parquet(f"{SF_DIR}/documents.parquet")))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    counted = ledger.ablations(held)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in counted and "Join" not in counted


def test_documents_of_good_quality_are_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = ledger.with_verdict(ledger.rule_ledger(docs)).filter("failed & 3 = 0")
    told = held.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = {r[0]: r[1] for r in told}
    assert share[1] > 0.99 and share[0] < 0.05


# --- centroid clustering -----------------------------------------------------


def plain_clusters(listed, k=40, rounds=5, scale=256, seed=2):
    """Lloyd's rounds with every distance worked out."""
    kept = []
    for vec_id, v in listed:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(scale * float(np.float32(x)))) for x in v]))

    def name(vec_id):
        return hashlib.sha256(f"{seed}:{'' if vec_id is None else vec_id}".encode()).hexdigest()

    points = [v for _, v in sorted(kept, key=lambda x: (name(x[0]), x[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _i, v in kept:
            groups[nearest(v)[1]].append(v)
        points = [
            [sum(c) // len(groups[i]) for c in zip(*groups[i], strict=True)] if i in groups else p
            for i, p in enumerate(points)
        ]
    last = [(vec_id, *nearest(v)[::-1]) for vec_id, v in kept]
    inertia = Counter()
    for _i, c, d in last:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in last), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, block int"


def vectors(spark, listed):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in listed], VECTORS).repartition(3)


def odd_vectors():
    draw = np.random.default_rng(11)
    middles = draw.normal(size=(6, 64))
    listed = [(i, (middles[i % 6] + 0.05 * draw.normal(size=64)).tolist()) for i in range(150)]
    listed += [(1000 + i, draw.integers(-1, 2, 64).astype(float).tolist()) for i in range(30)]
    listed += [(2000 + i, [0.5] * 64) for i in range(20)]
    listed += [(7, listed[7][1]), (None, [0.25] * 64), (None, [0.25] * 64), (None, None)]
    listed += [(3000, None), (3001, []), (3002, [1.0] * 63), (3003, [1.0] * 65)]
    listed += [(3004, [float("nan")] + [0.0] * 63), (3005, [float("-inf")] + [0.0] * 63)]
    return [*listed, (3006, [None] + [0.0] * 63), (3007, [0.0] * 64)]


@pytest.mark.parametrize("k, rounds", [(40, 5), (3, 4), (1, 2), (250, 2), (2, 0)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    listed = odd_vectors()
    got = shallot.cluster_vectors(vectors(spark, listed), k, rounds)
    assert rows(got) == plain_clusters(listed, k, rounds)


def test_clusters_of_few_or_no_vectors(spark):
    assert shallot.cluster_vectors(vectors(spark, [(1, None)])).collect() == []
    few = [(1, [0.0] * 64), (1, [0.0] * 64), (2, [1.0] * 64)]
    assert rows(shallot.cluster_vectors(vectors(spark, few))) == plain_clusters(few)
    with pytest.raises(ValueError):
        shallot.cluster_vectors(vectors(spark, few), 0)


def test_huge_components_raise(spark):
    far = [(1, [0.0] * 64), (2, [1e30] * 64)]
    with pytest.raises(ArithmeticError):
        shallot.cluster_vectors(vectors(spark, far))


def test_bounds_save_most_distances():
    draw = np.random.default_rng(2)
    middles = draw.normal(size=(20, 64)) * 500
    v = np.floor(middles[draw.integers(0, 20, 4000)] + draw.normal(size=(4000, 64)) * 20).astype(np.int64)
    points = np.floor(middles + draw.normal(size=(20, 64)) * 30).astype(np.int64)
    centroids, bounds = shallot.Centroids.of(points), shallot.Bounds.unknown(4000, 20)
    first = shallot.assign(v, centroids, bounds)
    moved = shallot.Centroids.of(points + 1)
    bounds.follow(centroids.moved_to(moved))
    again = shallot.assign(v, moved, bounds)
    every = ((v[:, None, :] - moved.points) ** 2).sum(2)
    assert bounds.near.tolist() == every.argmin(1).tolist()
    assert first > 4000 and again < 4000 * 0.1


def test_bounds_stay_right_over_random_moves():
    draw = np.random.default_rng(4)
    v = draw.integers(-4, 5, (600, 8))
    now = shallot.Centroids.of(draw.integers(-4, 5, (9, 8)))
    bounds = shallot.Bounds.unknown(600, 9)
    for _ in range(12):
        shallot.assign(v, now, bounds)
        every = ((v[:, None, :] - now.points) ** 2).sum(2)
        assert bounds.near.tolist() == every.argmin(1).tolist()
        exact = np.sqrt(np.sort(every, axis=1))
        assert (bounds.upper >= exact[:, 0]).all()
        rest = np.where(np.arange(9) == bounds.near[:, None], np.inf, every).min(1)
        assert (bounds.lower <= np.sqrt(rest)).all()
        new = shallot.Centroids.of(now.points + draw.integers(-1, 2, (9, 8)))
        bounds.follow(now.moved_to(new))
        now = new


def test_rounds_shuffle_no_vectors(spark):
    """Beyond the size Spark broadcasts, state and vectors meet by their buckets."""
    kept = shallot.kept_vectors(vectors(spark, odd_vectors()))
    blocks = shallot._Blocks(shallot._packed(kept, 64, 256))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        now = shallot.Centroids.of(shallot.first_centroids(kept, 40, 256, 2))
        state = blocks.state(shallot._round(blocks.vectors, None, None, now))
        plan = shallot._round(blocks.vectors, state, now, now)._jdf.queryExecution()
        text = plan.executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.set(threshold, before)
        blocks.close()
