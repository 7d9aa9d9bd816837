"""Text classification by averaged word and character n-gram vectors.

Words and their byte n-grams are hashed into a table of learned vectors; a text is
the average of its vectors, and a softmax layer on the average gives the classes.
Vectors and layer are trained together by stochastic gradient descent in numpy.
Because everything after the look-up is linear, a trained model needs one number per
table entry to score with: the entry's vector times the layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    give_back_memory,
    mixed,
    released,
    sent,
    span_hashes,
    text_of,
    text_slices,
    word_spans,
    written,
)

# Bytes of labelled texts whose shares a task adds up before the sums move.
ADDED_BYTES = 128 << 20


@dataclass(frozen=True)
class Settings:
    """What a model looks at and how it is trained."""

    buckets: int = 1 << 20
    shortest: int = 3
    longest: int = 5
    lower: bool = False
    repeats: bool = False
    dimensions: int = 4
    scale: float = 100.0
    rate: float = 1.0
    inertia: float = 0.1
    epochs: int = 100
    batch: int = 256
    contrast: float = 5.0
    sample_per_class: int = 3000
    seed: int = 7


@dataclass
class Model:
    """The score of a text is the logistic of ``bias`` plus the mean of its entries' weights."""

    weights: np.ndarray
    bias: float
    settings: Settings


def features(
    data: np.ndarray, offsets: np.ndarray, settings: Settings
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Table entries and rows of a slice's features, one kind of feature at a time."""
    if settings.lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    mask = np.uint64(settings.buckets - 1)
    begin, end, row = word_spans(data, offsets)
    if not len(begin):
        return
    words = span_hashes(data, begin, end)
    yield (words & mask).astype(np.int64), row
    if settings.repeats:
        for back in (1, 2):
            same = (words[back:] == words[:-back]) & (row[back:] == row[:-back])
            entry = int(mixed(np.array([back], np.uint64))[0] & mask)
            yield np.full(int(same.sum()), entry), row[back:][same]
    # The words again, each between two blanks, so that n-grams see where words end.
    lengths = end - begin
    place = np.concatenate([[0], np.cumsum(lengths + 1)])
    stream = np.full(place[-1] + 1, 32, np.uint8)
    inside = np.ones(place[-1] + 1, bool)
    inside[place] = False
    source = np.repeat(begin - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    stream[inside] = data[source + np.arange(len(source))]
    word_of = np.repeat(np.arange(len(begin)), lengths + 1)
    wide = stream.astype(np.uint64)
    key = wide
    blanks = np.concatenate([[0], np.cumsum(~inside)])
    for n in range(2, settings.longest + 1):
        if len(stream) < n:
            return
        key = key[: len(stream) - n + 1] | (wide[n - 1:] << np.uint64(8 * (n - 1)))
        if n < settings.shortest:
            continue
        at = np.arange(len(key))
        whole = blanks[at + n - 1] == blanks[at + 1]
        entry = mixed(key[whole] + (np.uint64(n) << np.uint64(56))) & mask
        yield entry.astype(np.int64), row[word_of[at[whole] + 1 if n > 2 else at[whole]]]


def scored(texts: pa.Array, model: Model) -> np.ndarray:
    """The probability of class 1 of each text; a text without words gets the bias alone."""
    out = np.zeros(len(texts))
    for a, b, data, offsets in text_slices(texts):
        total, number = np.zeros(b - a), np.zeros(b - a)
        for entry, row in features(data, offsets, model.settings):
            total += np.bincount(row, model.weights[entry], minlength=b - a)
            number += np.bincount(row, minlength=b - a)
        logit = model.bias + total / np.maximum(number, 1)
        out[a:b] = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
    return out


def counted(texts: pa.Array, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct entries of each text and their share in it."""
    for a, b, data, offsets in text_slices(texts):
        found = list(features(data, offsets, settings))
        entry = np.concatenate([e for e, _ in found]) if found else np.zeros(0, np.int64)
        row = np.concatenate([r for _, r in found]) if found else np.zeros(0, np.int64)
        pair, count = np.unique(row * settings.buckets + entry, return_counts=True)
        cut = np.searchsorted(pair, np.arange(b - a + 1) * settings.buckets)
        for i in range(b - a):
            share = count[cut[i]:cut[i + 1]]
            yield pair[cut[i]:cut[i + 1]] % settings.buckets, share / max(share.sum(), 1)


def telling(
    entries: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray, settings: Settings
) -> np.ndarray:
    """Entries whose mean share differs between the classes by ``contrast`` standard errors.

    The error is that of two classes alike: an entry that the smaller class alone has,
    in a few of its texts, stands out.
    """
    total, square = np.zeros((2, settings.buckets)), np.zeros((2, settings.buckets))
    for c in (0, 1):
        rows = np.flatnonzero(labels == c)
        for first in range(0, len(rows), settings.batch):
            some = rows[first:first + settings.batch]
            entry = np.concatenate([entries[r] for r in some])
            share = np.concatenate([shares[r] for r in some]).astype(float)
            total[c] += np.bincount(entry, share, minlength=settings.buckets)
            square[c] += np.bincount(entry, share**2, minlength=settings.buckets)
    texts = np.bincount(labels, minlength=2)[:, None]
    mean = total / texts
    spread = square.sum(0) / len(labels) - (total.sum(0) / len(labels)) ** 2
    error = np.maximum(spread, 0) * (1 / texts).sum()
    apart = np.abs(mean[1] - mean[0])
    return np.flatnonzero((apart > 0) & (apart >= settings.contrast * np.sqrt(error)))


def train(
    entries: list[np.ndarray],
    shares: list[np.ndarray],
    labels: np.ndarray,
    settings: Settings,
    used: np.ndarray | None = None,
) -> Model:
    """Minibatch gradient descent with a step size of its own per table entry.

    Only telling entries are trained; the others keep the zero vector, as entries never
    seen do, so that no text is learned by heart through words that say nothing. They are
    ``used``, or told by the rows given. With one class only, or none, the model knows that class, or even odds.
    """
    labels = np.asarray(labels, np.int64)
    weights = np.zeros(settings.buckets, np.float32)
    present = np.unique(labels)
    if len(present) < 2:
        return Model(weights, 0.0 if not len(present) else 4.0 * (2 * int(present[0]) - 1), settings)
    if used is None:
        used = telling(entries, shares, labels, settings)
    compact = np.full(settings.buckets, -1, np.int32)
    compact[used] = np.arange(len(used))
    kept = [compact[e] for e in entries]
    shares = [s[k >= 0] for s, k in zip(shares, kept, strict=True)]
    kept = [k[k >= 0] for k in kept]

    draw = np.random.default_rng(settings.seed)
    size = settings.dimensions
    vectors = np.zeros((size, len(used)))
    speed = np.full(len(used), settings.inertia)
    layer = draw.normal(0, 1, (size, 2)) / np.sqrt(size)
    bias = np.zeros(2)
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        order = draw.permutation(len(labels))
        for first in range(0, len(order), settings.batch):
            rows = order[first:first + settings.batch]
            entry = np.concatenate([kept[r] for r in rows])
            share = settings.scale * np.concatenate([shares[r] for r in rows]).astype(float)
            owner = np.repeat(np.arange(len(rows)), [len(kept[r]) for r in rows])
            average = np.stack(
                [np.bincount(owner, v[entry] * share, minlength=len(rows)) for v in vectors], 1
            )
            logits = average @ layer + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            odds[np.arange(len(rows)), labels[rows]] -= 1
            odds *= balance[labels[rows], None]
            pull = odds @ layer.T
            layer -= rate * 0.01 * (average.T @ odds) / len(rows)
            bias -= rate * 0.1 * odds.sum(0) / len(rows)
            step = np.stack(
                [np.bincount(entry, share * pull[owner, k], minlength=len(used)) for k in range(size)]
            )
            speed += (step**2).mean(0)
            vectors -= rate * step / np.sqrt(speed)
    difference = settings.scale * (layer[:, 1] - layer[:, 0])
    weights[used] = difference @ vectors
    return Model(weights, float(bias[1] - bias[0]), settings)


# --- on Spark ------------------------------------------------------------------------


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """``doc_id``, ``digest``, ``bytes``, ``text``, ``label`` of every row to learn from, one per id and text.

    Ids with a null or contradictory label, or of no document, are left out. Digests are
    taken before rows move, so that who reads all but ``text`` moves and writes no text.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col(label).alias("label"))
        .filter("of is not null and label in (0, 1)")
        .groupBy("of")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .select("of", "label")
    )
    whole = F.coalesce("text", F.lit("")).cast("binary")
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .filter(learn)
        .withColumns({"digest": F.sha2(whole, 256), "bytes": F.octet_length(whole)})
    )
    rows = texts.join(known, F.col("doc_id") == F.col("of")).select(
        "doc_id", "digest", "bytes", "text", F.col("label").cast("int").alias("label")
    )
    return rows.dropDuplicates(["doc_id", "digest"])


def training_rows(
    labelled: DataFrame, settings: Settings, keys: DataFrame | None = None
) -> DataFrame:
    """A bounded sample of the labelled rows, chosen by hash of id and text.

    The sample holds at most ``sample_per_class`` texts of each class, however many texts
    an id has. ``keys`` are the columns of ``labelled`` but ``text``, if written down.
    """
    keys = labelled if keys is None else keys
    known = keys.select("doc_id", "digest", "label", F.xxhash64("doc_id", "digest").alias("at"))
    parts = [
        known.filter(F.col("label") == c)
        .orderBy("at", "doc_id", "digest")
        .limit(settings.sample_per_class)
        for c in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1]).select("doc_id", "digest")
    # At most twice sample_per_class rows: small enough to send to every task, and so only
    # their texts are joined with labels.
    return labelled.join(F.broadcast(chosen), ["doc_id", "digest"], "left_semi").select(
        "doc_id", "digest", "text", "label"
    )


def telling_entries(labelled: DataFrame, settings: Settings, keys: DataFrame) -> np.ndarray:
    """:func:`telling` over all labelled rows: the more there are, the rarer it may be.

    Each task adds up its rows; at most a number per table entry comes to the driver.
    ``keys`` are the columns of ``labelled`` but ``text``.
    """
    found = keys.groupBy("label").agg(F.count("*").alias("texts"), F.sum("bytes").alias("bytes"))
    sizes = {r["label"]: r for r in found.collect()}
    if len(sizes) < 2:
        return np.zeros(0, np.int64)
    texts = {label: r["texts"] for label, r in sizes.items()}
    # A task moves up to a row per table entry, however few its texts: its share of texts is
    # large, so that the sums stay a small part of them.
    whole = sum(r["bytes"] for r in sizes.values())
    tasks = max(labelled.sparkSession.sparkContext.defaultParallelism, -(-whole // ADDED_BYTES))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, settings.buckets))
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for label, (entry, share) in zip(labels, counted(batch.column(0), settings), strict=True):
                # Entries of a text are distinct.
                share = share.astype(np.float32).astype(float)
                sums[label, entry] += share
                sums[2, entry] += share**2
        at = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), *[pa.array(row[at]) for row in sums]],
            names=["entry", "none", "one", "square"],
        )
        del sums
        give_back_memory()

    parts = labelled.select("text", "label").coalesce(tasks).mapInArrow(
        add, "entry int, none double, one double, square double"
    )
    rows = float(texts[0] + texts[1])
    spread = F.col("square") / rows - ((F.col("none") + F.col("one")) / rows) ** 2
    error = F.greatest(spread, F.lit(0.0)) * (1 / texts[0] + 1 / texts[1])
    apart = F.abs(F.col("one") / texts[1] - F.col("none") / texts[0])
    found = (
        parts.groupBy("entry")
        .agg(*[F.sum(c).alias(c) for c in ("none", "one", "square")])
        # Sums in another order differ in their last digits.
        .filter((apart > 1e-12) & (apart >= settings.contrast * F.sqrt(error)))
        .select("entry")
        .toArrow()
    )
    return np.sort(np.asarray(found.column("entry").to_numpy(), np.int64))


def fit(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, settings: Settings
) -> Model:
    """A model of ``label`` from the rows that ``learn`` (on ``doc_id``) admits."""
    with released():
        return _fitted(docs, labels, label, learn, settings)


def _fitted(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, settings: Settings
) -> Model:
    labelled = labelled_rows(docs, labels, label, learn)
    keys = written(labelled.drop("text"), "labelled")
    used = telling_entries(labelled, settings, keys)
    held = sent(docs.sparkSession, used.astype(np.int32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells = np.zeros(settings.buckets, bool)
        tells[held.value] = True
        for batch in batches:
            found = [(e[tells[e]], s[tells[e]]) for e, s in counted(batch.column(2), settings)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([e.astype(np.int32) for e, _ in found], pa.list_(pa.int32())),
                    pa.array([s.astype(np.float32) for _, s in found], pa.list_(pa.float32())),
                    batch.column(3),
                ],
                names=["doc_id", "digest", "entries", "shares", "label"],
            )

    sample = training_rows(labelled, settings, keys).mapInArrow(
        count, "doc_id long, digest string, entries array<int>, shares array<float>, label int"
    )

    def learn_from(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[np.ndarray] = []
        shares: list[np.ndarray] = []
        classes: list[int] = []
        batch = None
        for batch in batches:
            entries += [np.asarray(v.values) for v in batch.column(2)]
            shares += [np.asarray(v.values) for v in batch.column(3)]
            classes += batch.column(4).to_pylist()
        model = train(entries, shares, np.array(classes, np.int64), settings, held.value)
        del entries, shares, batch
        give_back_memory()
        at = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([model.weights[at]], pa.list_(pa.float32())),
                pa.array([model.bias]),
            ],
            names=["entries", "weights", "bias"],
        )

    # The sample is bounded and has telling entries only, so one task can hold it; in the same order however tasks
    # came in, training gives the same model. Only the weights come to the driver.
    learned = sample.repartition(1).sortWithinPartitions("doc_id", "digest")
    found = learned.mapInArrow(
        learn_from, "entries array<int>, weights array<float>, bias double"
    ).toArrow()
    if not found.num_rows:
        return train([], [], np.zeros(0, np.int64), settings)
    model = Model(np.zeros(settings.buckets, np.float32), found.column("bias")[0].as_py(), settings)
    at, weights = (np.asarray(found.column(n)[0].values) for n in ("entries", "weights"))
    model.weights[at] = weights
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``; columns but ``text`` go along.

    Without a column ``text`` it is looked for in the struct ``row``, which is kept.
    """
    held = sent(docs.sparkSession, model)
    wanted = [f for f in docs.schema.fields if f.name != "text"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            kept = [batch.column(i) for i, n in enumerate(names) if n != "text"]
            found = scored(text_of(batch), held.value)
            give_back_memory()
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found)], names=[*[n for n in names if n != "text"], "score"]
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in wanted], "score double"])
    return docs.mapInArrow(apply, schema)
