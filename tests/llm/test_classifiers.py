import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid, quality, subwords, toxicity
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.subwords import (
    Settings,
    counted,
    features,
    fit,
    labelled_rows,
    scored,
    telling,
    telling_entries,
    train,
    training_rows,
)
from tests.llm.fixtures import SF_DIR, no_docs, odd_docs

TINY = Settings(buckets=1 << 14, epochs=20, contrast=1.0)


def held(doc_id, folds, number):
    return zlib.crc32(str(doc_id).encode()) % folds == number


@pytest.mark.parametrize(
    ("name", "label", "folds", "number", "threshold", "least"),
    [("op3_subword_quality", "quality", 5, 0, 0.3, 0.95),
     ("op8_subword_toxicity", "toxic", 3, 1, 0.7, 0.9)],
)
def test_held_out_accuracy(spark, name, label, folds, number, threshold, least):
    found = {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in found.values():
        assert r.held_out == held(r.doc_id, folds, number)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    judged = [(found[r.doc_id].predicted, r[label]) for r in labels if found[r.doc_id].held_out]
    assert len(judged) > 50
    assert np.mean([a == b for a, b in judged]) >= least
    flagged = [a for a, b in judged if b == 1]
    assert np.mean(flagged) > 0.7


def test_scores_do_not_depend_on_labels_or_order(spark):
    first = QUERIES["op8_subword_toxicity"](spark, SF_DIR).collect()
    again = QUERIES["op8_subword_toxicity"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.score) for r in first} == {(r.doc_id, r.score) for r in again}


@pytest.mark.parametrize("module", ["quality", "toxicity"])
def test_odd_documents_and_labels(spark, module):
    docs, labels = odd_docs(spark), "doc_id long, quality int, toxic int"
    fit, score = (
        (quality.quality_model, quality.score_quality) if module == "quality"
        else (toxicity.toxicity_model, toxicity.score_toxicity)
    )
    known = [(4, 1, 0), (5, 0, 1), (5, 0, 1), (6, 1, 0), (7, None, None), (None, 1, 1), (99, 0, 0), (8, 0, 1), (8, 1, 0)]
    for given in (known, known[:1], []):
        model = fit(docs, spark.createDataFrame(given, labels), TINY)
        got = score(docs, model).collect()
        assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
        blank = {r.score for r in got if r.doc_id in (1, 2, 3)}
        assert len(blank) == 1
        assert got[0].n_chars == "x" and len(set(got[0].__fields__)) == len(got[0].__fields__)
        assert score(no_docs(spark), model).collect() == []


def test_misspellings_share_what_was_learned():
    draw = np.random.default_rng(0)
    plain = ["river", "stone", "cloud", "meadow", "garden", "winter", "lantern"]
    texts, labels = [], []
    for i in range(300):
        words = list(draw.choice(plain, 12))
        if i % 2:
            words[draw.integers(12)] = draw.choice(["disgusting", "pathetic"])
        texts.append(" ".join(words))
        labels.append(i % 2)
    settings = Settings(buckets=1 << 16, epochs=40)
    held = list(counted(pa.array(texts), settings))
    model = train([e for e, _ in held], [s for _, s in held], np.array(labels), settings)
    bad, good = scored(pa.array(["stone cloud disgustin river", "stone cloud meadow river"]), model)
    assert bad > 0.7 > 0.3 > good
    # The weights hold what the vectors would give.
    assert scored(pa.array([""]), model)[0] == pytest.approx(1 / (1 + np.exp(-model.bias)))


def test_features_see_words_and_their_ends():
    def entries(text):
        data = np.frombuffer(text.encode(), np.uint8)
        found = features(data, np.array([0, len(data)]), Settings())
        return sorted(e for entry, _ in found for e in entry.tolist())

    assert entries("ab cd") == entries(" ab\n\tcd ")
    assert entries("ab cd") != entries("abc d")
    # A word, and " ab", "ab ", " ab ": two of three and one of four bytes.
    assert len(entries("ab")) == 4
    assert entries("") == entries("  ") == []


# --- language ------------------------------------------------------------------


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = QUERIES["op2_kneser_ney_langid"](spark, SF_DIR).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in found)
    judged = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert np.mean(judged) >= 0.97
    assert np.mean([r.accepted for r in found]) > 0.98


def models_of(texts):
    import pandas as pd

    parts = []
    for lang, text in texts.items():
        codes, begin = langid._padded(*langid.letters([text]), langid.ORDER)
        gram, n = np.unique(langid.gram_keys(codes, langid.ORDER), return_counts=True)
        parts.append(pd.DataFrame({"lang": lang, "gram": gram, "n": n}))
    return langid.build_models(pd.concat(parts))


def slow_cross_entropy(models, lang, text):
    """Straight from the definition, one character at a time."""
    at = models.langs.index(lang)
    tables = [dict(zip(level.hashes.tolist(), range(len(level.hashes)), strict=True)) for level in models.levels]
    codes, _ = langid._padded(*langid.letters([text]), langid.ORDER)

    def place(k, key):
        hashed = int(langid._hashes(np.array([key], np.int64))[0])
        return tables[k - 1].get(hashed)

    total, n = 0.0, 0
    for end in range(langid.ORDER - 1, len(codes)):
        window = codes[end - langid.ORDER + 1:end + 1].tolist()
        for k in range(langid.ORDER, 0, -1):
            key = 0
            for c in window[-k:]:
                key = (key << 12) | c
            found = place(k, key)
            if found is not None or k == 1:
                total += models.levels[k - 1].log_p[len(tables[0]) if found is None else found, at]
                break
            context = place(k - 1, key >> 12)
            total += models.levels[k - 2].log_rest[len(tables[k - 2]) if context is None else context, at]
        n += 1
    return -total / n


def test_cross_entropy_follows_the_definition():
    models = models_of({"aa": "banana bandana cabana " * 9, "bb": "queue quiet quick quit " * 9})
    texts = ["banana quick", "zebra", "quiet bandana!", "b"]
    nats, lengths = langid.cross_entropies(texts, models)
    for i, text in enumerate(texts):
        for lang in models.langs:
            want = slow_cross_entropy(models, lang, text)
            assert nats[i, models.langs.index(lang)] == pytest.approx(want, rel=1e-4)
    assert lengths.tolist() == [13, 6, 14, 2]


def test_probabilities_after_a_context_sum_to_one():
    models = models_of({"aa": "banana bandana cabana " * 9, "bb": "queue quiet quick quit " * 9})
    codes = np.arange(langid.ALPHABET)
    context = [ord("b"), ord("a"), ord("n")]
    key = np.zeros(len(codes), np.int64)
    for c in context:
        key = (key << 12) | c
    key = (key << 12) | codes
    level = models.levels
    total = np.zeros((len(codes), 2))
    left = np.arange(len(codes))
    for k in range(4, 0, -1):
        part = key[left] & ((1 << (12 * k)) - 1)
        at = langid._find(level[k - 1].hashes, langid._hashes(part))
        here = (at < len(level[k - 1].hashes)) | (k == 1)
        total[left[here]] += level[k - 1].log_p[at[here]]
        left = left[~here]
        if k > 1:
            total[left] += level[k - 2].log_rest[
                langid._find(level[k - 2].hashes, langid._hashes(key[left] >> 12 & ((1 << (12 * (k - 1))) - 1)))
            ]
    assert np.exp(total[:, 0]).sum() == pytest.approx(1, abs=1e-3)


def test_odd_texts_have_a_language_or_none(spark):
    docs = odd_docs(spark)
    models = langid.fit_languages(docs)
    got = langid.predict(docs, models).collect()
    assert len(got) == 12
    by = {r.doc_id: r for r in got}
    for doc_id in (1, 2, 3, 8):
        assert (by[doc_id].lang_pred, by[doc_id].score, by[doc_id].accepted) == ("und", 0.0, False)
    assert by[5].lang_pred in models.langs
    assert langid.predict(no_docs(spark), models).collect() == []
    nothing = langid.fit_languages(no_docs(spark))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_texts_of_no_language_are_rejected(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    models = langid.fit_languages(docs)
    draw = np.random.default_rng(1)
    noise = ["".join(draw.choice(list("qxzjkwvy bcdfg"), 600)) for _ in range(5)]
    assert not langid._decide(noise, models)[2].any()


def test_models_of_any_size_keep_every_gram(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    docs = docs.unionByName(odd_docs(spark).select("doc_id", "lang", "text"))
    held_models = langid.fit_languages(docs)
    monkeypatch.setattr(langid, "HELD_GRAMS", 100)
    monkeypatch.setattr(langid, "HOT_GRAMS", 50)
    stored = langid.fit_languages(docs)
    assert stored.langs == held_models.langs
    # All n-grams counted are in the model, those seen once as well.
    learned = docs.filter("lang is not null and text is not null and crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 4 != 2")
    counts = langid.gram_counts(learned)
    assert counts.filter("n = 1").count() > 100
    assert stored.grams[-1].count() == counts.count()
    assert len(held_models.levels[-1].hashes) == counts.select("gram").distinct().count()
    assert stored.limits == pytest.approx(held_models.limits, rel=1e-4)
    want = sorted(langid.predict(docs, held_models).collect(), key=repr)
    got = sorted(langid.predict(docs, stored).collect(), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert (a.doc_id, a.lang_pred, a.accepted) == (b.doc_id, b.lang_pred, b.accepted)
        assert a.score == pytest.approx(b.score, abs=1e-3)


def test_short_texts_alone_calibrate_their_language(spark):
    words = "river stone cloud meadow garden winter lantern morning".split()
    draw = np.random.default_rng(3)
    # Each id is given many times, and no text has 200 letters.
    texts = [(i % 40, "en", " ".join(draw.choice(words, 6))) for i in range(400)]
    models = langid.fit_languages(spark.createDataFrame(texts, "doc_id long, lang string, text string"))
    assert np.isfinite(models.limits).all()
    noise = ["qxzj kwvy " * 4, "qxzj kwvy " * 60]
    assert langid._decide(noise, models)[2].tolist() == [False, False]
    assert langid._decide([" ".join(words[:6])], models)[2].all()
    # The level is that of all rows outside the fold, whatever their number.
    rows = [t for i, _, t in texts if not held(i, 4, 2)]
    nats, lengths = langid.cross_entropies(rows, models)
    usual = np.sort(nats[(lengths >= 25) & (lengths < 50), 0])
    want = usual[int(np.ceil(0.99 * len(usual))) - 1]
    assert models.limits[0, 1] == pytest.approx(want + langid.MARGIN, abs=1e-6)


def test_rare_markers_become_telling_as_labels_grow(spark):
    draw = np.random.default_rng(5)
    plain = "river stone cloud meadow garden winter lantern morning".split()
    texts = []
    for i in range(8000):
        words = list(draw.choice(plain, 10))
        if i % 2:
            # One toxic text in forty has the rare word, the others a common one.
            words[draw.integers(10)] = "wqzjx" if i % 80 == 1 else "disgusting"
        texts.append((i, " ".join(words), i % 2))
    given = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    # The sample has about ten texts with the rare word, which alone tell nothing.
    settings = Settings(buckets=1 << 16, epochs=40, contrast=6.0, sample_per_class=400)
    model = fit(given.select("doc_id", "text"), given.select("doc_id", "toxic"), "toxic", F.lit(True), settings)
    rare, good = scored(pa.array(["stone cloud wqzjx river", "stone cloud meadow river"]), model)
    assert rare > 0.7 > 0.3 > good


def test_samples_have_their_full_size():
    assert quality.SETTINGS.sample_per_class == 2000
    assert toxicity.SETTINGS.sample_per_class == 3000


def test_samples_count_texts_of_documents(spark):
    texts = [(i, f"text {i}") for i in range(20)] + [(1, "text 1")] * 40 + [(2, f"other {j}") for j in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    # Most labelled ids are of no document.
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    labelled = labelled_rows(docs, labels, "toxic", F.lit(True))
    assert labelled.count() == 60
    sample = training_rows(labelled, Settings(sample_per_class=8)).collect()
    assert sorted(r.label for r in sample) == [0] * 8 + [1] * 8
    assert len({(r.doc_id, r.text) for r in sample}) == 16


def test_learning_writes_no_labelled_texts(spark):
    draw = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    texts = [(i, "".join(draw.choice(letters, 4000)), i % 2) for i in range(300)]
    given = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))

    def kept():
        return sum(f.stat().st_size for f in shared.rglob("*") if f.is_file())

    before = kept()
    settings = Settings(buckets=1 << 14, epochs=2, sample_per_class=10)
    fit(given.select("doc_id", "text"), given.select("doc_id", "toxic"), "toxic", F.lit(True), settings)
    # Digests and labels of all rows, but not the 1.2 MB of their texts.
    assert 0 < kept() - before < 120_000


@pytest.mark.parametrize("added", [1 << 10, 1 << 27])
def test_telling_entries_are_those_of_all_distinct_rows(spark, monkeypatch, added):
    monkeypatch.setattr(subwords, "ADDED_BYTES", added)
    draw = np.random.default_rng(12)
    plain = "river stone cloud meadow garden winter lantern morning".split()
    texts = []
    for i in range(400):
        words = list(draw.choice(plain, 10))
        if i % 2:
            words[draw.integers(10)] = "disgusting"
        texts.append((i, " ".join(words), i % 2))
    texts += [(400, None, 0), (401, "", 1)]
    # Rows that come again count once; contradictory and ownerless labels teach nothing.
    docs = spark.createDataFrame(
        [t[:2] for t in texts + texts[:50] * 3] + [(900, "meadow")] * 2 + [(None, "disgusting")],
        "doc_id long, text string",
    ).repartition(7)
    labels = spark.createDataFrame(
        [(i, c) for i, _, c in texts] + [(900, 0), (900, 1), (None, 0), (901, 1)],
        "doc_id long, toxic int",
    )
    settings = Settings(buckets=1 << 14, contrast=4.0)
    labelled = labelled_rows(docs, labels, "toxic", F.lit(True))
    got = telling_entries(labelled, settings, labelled.drop("text"))
    rows = list(counted(pa.array([t for _, t, _ in texts]), settings))
    want = telling([e for e, _ in rows], [s for _, s in rows], np.array([c for *_, c in texts]), settings)
    assert got.tolist() == want.tolist() and len(got) > 5
