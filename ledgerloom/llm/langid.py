"""Language identification by interpolated Kneser-Ney character models.

Texts become lower-case letters with single blanks between words. Every language has a
model of the next character given up to ``ORDER - 1`` before it; the language whose
model needs the fewest nats per character wins, and texts that no model fits are
rejected at a level calibrated on all training texts of that language and length class.

Counts cover every labelled row outside the held-out fold, and every n-gram counted is
in the model. A model that one task can hold is a few sorted arrays of n-gram hashes with
a column of log probabilities per language; a larger one stays in written tables, and
texts' n-grams are joined with them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold, give_back_memory, mixed, released, sent, text_of, written

ORDER = 4
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

# N-grams of the highest order, of all languages together, up to which every task gets
# the model. A larger model is joined with instead; both give the same probabilities.
HELD_GRAMS = 1_600_000
# N-grams in the most texts, whose probabilities are sent to the tasks of that join, so
# that the rows of a very common n-gram are not all dealt to one task.
HOT_GRAMS = 1 << 14
# Lengths at which a new class of texts begins, each with a level of rejection of its own,
# and the margin in nats per character beyond what a language's texts need.
LENGTH_CLASSES = (25, 50, 100, 200)
MARGIN = 0.35
# Texts shorter than this spread more; the margin grows by their length's square root.
FULL_LENGTH = 200

# Texts are worked on in blocks of this many characters, at some 150 bytes each.
BLOCK_CHARS = 1 << 18

# Letters above this code point are folded into this many classes.
ALPHABET = 1 << 12
BLANK = 32


@functools.cache
def _classes() -> np.ndarray:
    """A code per code point: letters lower-cased, everything else a blank.

    Code points beyond the alphabet share codes by remainder, which joins scripts far
    apart but keeps n-gram keys within 64 bits at any order up to five.
    """
    codes = np.full(0x110000, BLANK, np.uint16)
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        character = chr(point)
        if character.isalpha():
            lower = ord(character.lower()[0])
            codes[point] = lower if lower < ALPHABET else 0x800 + lower % 0x800
    return codes


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts on end, and where each begins: a blank, words and blanks, a blank.

    A text without letters is empty.
    """
    whole = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _classes()[np.minimum(whole, 0x10FFFF)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # A blank after every text, then blanks after blanks drop out.
    out = np.full(len(codes) + len(texts), BLANK, np.uint16)
    row = np.repeat(np.arange(len(texts)), lengths)
    out[np.arange(len(codes)) + row] = codes
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != BLANK) | (out[:-1] != BLANK)
    keep[0] = bool(len(out)) and out[0] != BLANK
    # Now each text is words with one blank after each; a leading blank serves the next.
    first = starts[:-1] + np.arange(len(texts))
    leading = np.zeros(len(out), bool)
    leading[first] = out[first] == BLANK
    keep &= ~leading
    kept, owner = out[keep], owner[keep]
    count = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(count + (count > 0))])
    final = np.full(begin[-1], BLANK, np.uint16)
    ahead = np.cumsum(count > 0)[owner]
    final[np.arange(len(kept)) + ahead] = kept
    return final, begin


def gram_keys(codes: np.ndarray, order: int) -> np.ndarray:
    """The n-grams ending at each place from ``order - 1`` on, twelve bits a character."""
    if len(codes) < order:
        return np.zeros(0, np.int64)
    wide = codes.astype(np.int64)
    key = wide[: len(codes) - order + 1].copy()
    for i in range(1, order):
        key = (key << 12) | wide[i:len(codes) - order + 1 + i]
    return key


def _padded(codes: np.ndarray, begin: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``order - 2`` more blanks ahead, so that every character has a context."""
    ahead = order - 2
    count = np.diff(begin)
    has = count > 0
    shift = np.cumsum(has) * ahead
    out = np.full(len(codes) + int(has.sum()) * ahead, BLANK, np.uint16)
    owner = np.repeat(np.arange(len(count)), count)
    out[np.arange(len(codes)) + shift[owner]] = codes
    return out, np.concatenate([[0], np.cumsum(count + has * ahead)])


def _blocks(texts: list[str], rows: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers in blocks of about ``BLOCK_CHARS`` characters; a text is not divided."""
    block: list[int] = []
    size = 0
    for r in rows:
        block.append(int(r))
        size += len(texts[r])
        if size >= BLOCK_CHARS:
            yield np.array(block)
            block, size = [], 0
    if block:
        yield np.array(block)


# --- counting --------------------------------------------------------------------


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n``: every n-gram of the highest order in ``lang``, ``text``.

    A task adds up its own counts first and hands them on when they grow large.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pd.Series]] = {}
        size = 0

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                total = pd.concat(parts).groupby(level=0).sum()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(total), pa.string()),
                        pa.array(total.index.to_numpy()),
                        pa.array(total.to_numpy()),
                    ],
                    names=["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lang in set(langs.tolist()):
                for block in _blocks(texts, np.flatnonzero(langs == lang)):
                    codes, begin = _padded(*letters([texts[r] for r in block]), ORDER)
                    key = gram_keys(codes, ORDER)
                    inside = _inside(begin, len(key))
                    gram, n = np.unique(key[inside], return_counts=True)
                    held.setdefault(lang, []).append(pd.Series(n, gram))
                    size += len(gram)
            if size > 1 << 21:
                yield from handed()
                size = 0
        yield from handed()

    parts = rows.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _inside(begin: np.ndarray, n: int) -> np.ndarray:
    """Which n-grams lie within one text."""
    keep = np.ones(max(n, 0), bool)
    for back in range(1, ORDER):
        at = begin[1:-1] - back
        keep[at[(at >= 0) & (at < n)]] = False
    return keep


# --- the model -------------------------------------------------------------------


@dataclass
class Level:
    """N-grams of one order as sorted hashes; per language the log of their probability,
    and, as contexts of the next order, the log of the weight left to shorter contexts."""

    hashes: np.ndarray
    log_p: np.ndarray
    log_rest: np.ndarray


@dataclass
class LanguageModels:
    langs: list[str]
    levels: list[Level]
    limits: np.ndarray

    @property
    def known(self) -> bool:
        return bool(self.langs)


def no_limits(langs: int) -> np.ndarray:
    return np.full((langs, len(LENGTH_CLASSES) + 1), np.inf)


def _hashes(key: np.ndarray) -> np.ndarray:
    return mixed(key.view(np.uint64))


def _find(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of hashes in a sorted array; the array's length where absent."""
    at = np.searchsorted(hashes, wanted)
    at[at == len(hashes)] = 0
    return np.where(hashes[at] == wanted, at, len(hashes))


def kneser_ney(counts: pd.DataFrame, order: int) -> dict[int, pd.DataFrame]:
    """Interpolated Kneser-Ney from one language's counts (``gram``, ``n``) of ``order``.

    Per order: ``gram``, ``p`` and, by context, ``rest``: the weight that goes to the
    next shorter context. Below the highest order an n-gram counts the different
    characters it follows. Order 1 is interpolated with an even spread.
    """
    out: dict[int, pd.DataFrame] = {}
    level = counts[["gram", "n"]].astype({"n": float})
    tables = {order: level}
    for k in range(order - 1, 0, -1):
        shorter = tables[k + 1]["gram"].to_numpy() & ((1 << (12 * k)) - 1)
        tables[k] = pd.DataFrame({"gram": shorter, "n": 1.0}).groupby("gram", as_index=False).sum()
    lower: pd.Series | None = None
    for k in range(1, order + 1):
        grams = tables[k].copy()
        once, twice = (grams["n"] == 1).sum(), (grams["n"] == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        grams["context"] = grams["gram"].to_numpy() >> 12
        by = grams.groupby("context")["n"]
        total, kinds = by.transform("sum"), by.transform("size")
        grams["rest"] = discount * kinds / total
        if lower is None:
            base = np.full(len(grams), 1.0 / ALPHABET)
        else:
            suffix = grams["gram"].to_numpy() & ((1 << (12 * (k - 1))) - 1)
            base = lower.reindex(suffix).to_numpy()
        grams["p"] = (grams["n"] - discount) / total + grams["rest"] * base
        lower = pd.Series(grams["p"].to_numpy(), grams["gram"].to_numpy())
        out[k] = grams[["gram", "context", "p", "rest"]]
    return out


def build_models(counts: pd.DataFrame) -> LanguageModels:
    """Models of all languages in ``lang``, ``gram``, ``n``, side by side in sorted arrays.

    An n-gram that only some languages know has, for the others, what their shorter
    contexts give, so that a look-up at the longest n-gram found serves all languages.
    """
    langs = sorted(counts["lang"].unique())
    estimates = [kneser_ney(counts[counts["lang"] == lang], ORDER) for lang in langs]
    levels: list[Level] = []
    shorter_p: dict[int, np.ndarray] = {}
    known_grams = np.zeros(0, np.int64)
    for k in range(1, ORDER + 1):
        grams = np.unique(np.concatenate([e[k]["gram"].to_numpy() for e in estimates]))
        log_p = np.zeros((len(grams) + 1, len(langs)))
        rests = np.zeros((len(known_grams) + 1, len(langs)))
        for i, estimate in enumerate(estimates):
            by_context = estimate[k].drop_duplicates("context")
            if k > 1:
                place = np.searchsorted(known_grams, by_context["context"].to_numpy())
                place[place == len(known_grams)] = 0
                hit = known_grams[place] == by_context["context"].to_numpy()
                rests[place[hit], i] = np.log(by_context["rest"].to_numpy()[hit])
                suffix = grams & ((1 << (12 * (k - 1))) - 1)
                at = np.searchsorted(known_grams, suffix)
                at[at == len(known_grams)] = 0
                at = np.where(known_grams[at] == suffix, at, len(known_grams))
                context = np.searchsorted(known_grams, grams >> 12)
                context[context == len(known_grams)] = 0
                context = np.where(known_grams[context] == grams >> 12, context, len(known_grams))
                log_p[:-1, i] = shorter_p[k - 1][at, i] + rests[context, i]
            else:
                log_p[:, i] = np.log(by_context["rest"].iloc[0] / ALPHABET)
            own = np.searchsorted(grams, estimate[k]["gram"].to_numpy())
            log_p[own, i] = np.log(estimate[k]["p"].to_numpy())
        if k > 1:
            levels[-1].log_rest = rests.astype(np.float32)
        if k == 1:
            log_p[-1] = [np.log(e[1]["rest"].iloc[0] / ALPHABET) for e in estimates]
        shorter_p[k] = log_p
        levels.append(Level(grams, log_p.astype(np.float32), np.zeros((len(grams) + 1, len(langs)), np.float32)))
        known_grams = grams
    for level in levels:
        hashes = _hashes(level.hashes)
        order = np.argsort(hashes)
        level.hashes = hashes[order]
        level.log_p[:-1] = level.log_p[:-1][order]
        level.log_rest[:-1] = level.log_rest[:-1][order]
    return LanguageModels(list(langs), levels, no_limits(len(langs)))


def cross_entropies(texts: list[str], models: LanguageModels) -> tuple[np.ndarray, np.ndarray]:
    """Nats per character of every text (rows) under every language, and the texts' lengths."""
    found = np.zeros((len(texts), len(models.langs)))
    lengths = np.zeros(len(texts), np.int64)
    for block in _blocks(texts, np.arange(len(texts))):
        codes, begin = _padded(*letters([texts[r] for r in block]), ORDER)
        key = gram_keys(codes, ORDER)
        n = len(key)
        if not n:
            continue
        top = models.levels[-1]
        place = _find(top.hashes, _hashes(key))
        log_p = top.log_p[place]
        left = np.flatnonzero(place == len(top.hashes))
        # Where the n-gram is new, shorter ones, at the cost of leaving each context.
        log_p[left] = 0
        for k in range(ORDER - 1, 0, -1):
            if not len(left):
                break
            level = models.levels[k - 1]
            context = (key[left] >> 12) & ((1 << (12 * k)) - 1)
            log_p[left] += level.log_rest[_find(level.hashes, _hashes(context))]
            at = _find(level.hashes, _hashes(key[left] & ((1 << (12 * k)) - 1)))
            here = (at < len(level.hashes)) if k > 1 else np.ones(len(at), bool)
            log_p[left[here]] += level.log_p[at[here]]
            left = left[~here]
        log_p[~_inside(begin, n)] = 0
        sums = np.concatenate([np.zeros((1, len(models.langs))), np.cumsum(log_p, 0, dtype=float)])
        ends = np.maximum(begin[1:] - ORDER + 1, 0)
        firsts = np.minimum(begin[:-1], ends)
        count = np.maximum(np.diff(begin) - ORDER + 1, 0)
        lengths[block] = count
        found[block] = -(sums[ends] - sums[firsts]) / np.maximum(count, 1)[:, None]
    return found, lengths


# --- models too large for a task --------------------------------------------------


@dataclass
class StoredModels:
    """Models in tables, one row per language and n-gram or context of each order."""

    langs: list[str]
    grams: list[DataFrame]
    rests: list[DataFrame]
    limits: np.ndarray

    @property
    def known(self) -> bool:
        return bool(self.langs)


def _low(gram: Column, order: int) -> Column:
    """The last ``order`` characters of an n-gram."""
    return gram.bitwiseAND(F.lit((1 << (12 * order)) - 1))


def stored_models(counts: DataFrame, langs: list[str]) -> StoredModels:
    """:func:`build_models` as Spark aggregates and joins; nothing comes to the driver.

    ``grams`` hold ``lang``, ``gram``, ``p``; ``rests`` the weight ``rest`` that a
    ``context`` leaves to shorter ones.
    """
    tables = {ORDER: counts.select("lang", "gram", F.col("n").cast("double").alias("n"))}
    for k in range(ORDER - 1, 0, -1):
        shorter = tables[k + 1].groupBy("lang", _low(F.col("gram"), k).alias("gram"))
        tables[k] = written(shorter.agg(F.count(F.lit(1)).cast("double").alias("n")), f"langid-counts-{k}")
    grams: list[DataFrame] = []
    rests: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        once, twice = (F.count_if(F.col("n") == c).cast("double") for c in (1, 2))
        seen = tables[k].groupBy("lang").agg(once.alias("once"), twice.alias("twice"))
        discounts = seen.select(
            "lang",
            F.when(
                (F.col("once") > 0) & (F.col("twice") > 0),
                F.col("once") / (F.col("once") + 2 * F.col("twice")),
            ).otherwise(0.5).alias("discount"),
        )
        placed = tables[k].withColumn("context", F.shiftright("gram", 12))
        # A row per language.
        contexts = written(
            placed.groupBy("lang", "context")
            .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            .join(F.broadcast(discounts), "lang")
            .withColumn("rest", F.col("discount") * F.col("kinds") / F.col("total")),
            f"langid-contexts-{k}",
        )
        whole = placed.join(contexts, ["lang", "context"])
        own = (F.col("n") - F.col("discount")) / F.col("total")
        if k == 1:
            found = whole.select("lang", "gram", (own + F.col("rest") / ALPHABET).alias("p"))
        else:
            base = grams[-1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("base"))
            found = (
                whole.withColumn("suffix", _low(F.col("gram"), k - 1))
                .join(base, ["lang", "suffix"])
                .select("lang", "gram", (own + F.col("rest") * F.col("base")).alias("p"))
            )
            # As in build_models, contexts that are no n-gram themselves leave all weight.
            known = tables[k - 1].select(F.col("gram").alias("context")).distinct()
            contexts = contexts.join(known, "context", "left_semi")
        grams.append(written(found, f"langid-model-{k}"))
        rests.append(contexts.select("lang", "context", "rest"))
    return StoredModels(langs, grams, rests, no_limits(len(langs)))


def _log_probabilities(wanted: DataFrame, models: StoredModels) -> DataFrame:
    """``gram`` and ``log_p``, an entry per language, for the distinct ``gram`` of ``wanted``."""
    spark = wanted.sparkSession
    langs = spark.createDataFrame(list(enumerate(models.langs)), "i int, lang string")
    shorter: DataFrame | None = None
    for k in range(1, ORDER + 1):
        here = wanted.select(_low(F.col("gram"), k).alias("gram")).distinct()
        each = here.crossJoin(F.broadcast(langs)).withColumns(
            {"context": F.shiftright("gram", 12), "suffix": _low(F.col("gram"), k - 1)}
        )
        each = each.join(models.grams[k - 1], ["lang", "gram"], "left").join(
            models.rests[k - 1], ["lang", "context"], "left"
        )
        left = F.coalesce(F.log("rest"), F.lit(0.0))
        if shorter is None:
            base = left - F.log(F.lit(float(ALPHABET)))
        else:
            each = each.join(
                shorter.select("lang", F.col("gram").alias("suffix"), F.col("log_p").alias("base")),
                ["lang", "suffix"],
            )
            base = left + F.col("base")
        shorter = written(
            each.select("lang", "i", "gram", F.coalesce(F.log("p"), base).alias("log_p")), f"langid-wanted-{k}"
        )
    listed = F.sort_array(F.collect_list(F.struct("i", "log_p")))
    return shorter.groupBy("gram").agg(listed["log_p"].alias("log_p"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _stored_entropies(texts: DataFrame, models: StoredModels) -> DataFrame:
    """``_digest``, ``_nats`` (as in :func:`cross_entropies`) and ``_length`` of distinct ``text``.

    Every text's distinct n-grams are joined with their probabilities. Texts without a
    letter have no row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column(0)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for block in _blocks(texts, np.arange(len(texts))):
                codes, begin = _padded(*letters([texts[r] for r in block]), ORDER)
                key = gram_keys(codes, ORDER)
                found = [
                    np.unique(key[a:max(b - ORDER + 1, a)], return_counts=True)
                    for a, b in zip(begin[:-1], begin[1:], strict=True)
                ]
                owner = np.repeat(block, [len(g) for g, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        digests.take(pa.array(owner)),
                        pa.array(np.concatenate([g for g, _ in found])),
                        pa.array(np.concatenate([n for _, n in found])),
                    ],
                    names=["_digest", "gram", "n"],
                )
            give_back_memory()

    distinct = texts.select(_digest(F.col("text")).alias("_digest"), "text").dropDuplicates(["_digest"])
    pairs = written(distinct.mapInArrow(count, "_digest binary, gram long, n long"), "langid-pairs")
    wanted = written(pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("texts")), "langid-wanted")
    found = written(_log_probabilities(wanted, models), "langid-found")
    hot = wanted.orderBy(F.desc("texts"), "gram").limit(HOT_GRAMS).select("gram")
    hot = F.broadcast(written(hot, "langid-hot"))
    parts = [
        pairs.join(hot, "gram", "left_semi").join(F.broadcast(found.join(hot, "gram", "left_semi")), "gram"),
        pairs.join(hot, "gram", "left_anti").join(found, "gram"),
    ]
    sums = [F.sum(F.col("n") * F.col("log_p")[i]) for i in range(len(models.langs))]
    length = F.sum("n")
    return (
        parts[0]
        .unionByName(parts[1])
        .groupBy("_digest")
        .agg(F.array(*[-s / length for s in sums]).alias("_nats"), length.alias("_length"))
    )


# --- fitting and deciding ----------------------------------------------------------


def fit_languages(docs: DataFrame) -> LanguageModels | StoredModels:
    """Models of every language that rows with text and language outside the fold name.

    Counts are taken over all those rows, and all n-grams counted make the model. It
    comes to the driver if it has at most ``HELD_GRAMS``.
    """
    rows = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    counts = written(gram_counts(rows), "langid-counts")
    sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModels([], [], no_limits(0))
    if sum(sizes.values()) <= HELD_GRAMS:
        models = build_models(counts.toPandas().sort_values(["lang", "gram"]))
    else:
        models = stored_models(counts, sorted(sizes))
    models.limits = _limits(rows, models)
    return models


def _limits(rows: DataFrame, models: LanguageModels | StoredModels) -> np.ndarray:
    """The level of rejection of each language (rows) and length class.

    It is what 99 % of all the language's rows of that class need, to a ten-thousandth of
    their number, and the margin. A class without rows takes the level of the next longer
    class that has some, or else of the next shorter one.
    """
    place = F.array_position(F.array(*[F.lit(lang) for lang in models.langs]), F.col("lang"))
    longer = [(F.col("_length") >= least).cast("int") for least in LENGTH_CLASSES]
    # A row per language and class.
    with released():
        found = (
            _scored(rows.select("lang", "text"), models)
            .filter("_length > 0")
            .groupBy((place - 1).alias("i"), functools.reduce(lambda a, b: a + b, longer).alias("c"))
            .agg(F.percentile_approx(F.element_at("_nats", place.cast("int")), 0.99, 10_000).alias("usual"))
            .collect()
        )
    known = np.full((len(models.langs), len(LENGTH_CLASSES) + 1), np.nan)
    for r in found:
        known[r["i"], r["c"]] = r["usual"] + MARGIN
    return pd.DataFrame(known).bfill(axis=1).ffill(axis=1).fillna(np.inf).to_numpy()


def _scored(docs: DataFrame, models: LanguageModels | StoredModels) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``_nats`` per language and ``_length``."""
    kept_fields = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in kept_fields]
    if isinstance(models, StoredModels):
        text = F.col("text") if "text" in docs.columns else F.col("row.text")
        found = _stored_entropies(docs.select(text.alias("text")), models)
        scores = written(found, "langid-scores").withColumnRenamed("_digest", "_of_digest")
        return (
            docs.select(*[F.col(f"`{n}`") for n in names], _digest(text).alias("_digest"))
            .join(scores, F.col("_digest") == F.col("_of_digest"), "left")
            .withColumn("_length", F.coalesce("_length", F.lit(0).cast("long")))
            .drop("_digest", "_of_digest")
        )
    held = sent(docs.sparkSession, models)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nats, lengths = cross_entropies([t or "" for t in text_of(batch).to_pylist()], held.value)
            give_back_memory()
            kept = [batch.column(batch.schema.names.index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(list(nats), pa.list_(pa.float64())), pa.array(lengths)],
                names=[*names, "_nats", "_length"],
            )

    schema = ", ".join(
        [*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept_fields], "_nats array<double>, _length long"]
    )
    return docs.mapInArrow(apply, schema)


def predict(docs: DataFrame, models: LanguageModels | StoredModels) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``held_out``, ``lang_pred``, ``score``, ``accepted``.

    Only the text decides. ``lang_pred`` is the language of the lowest cross-entropy,
    ties to the first by name, or ``und`` for a text that is null or has no letter, or
    when no language was learned. ``score`` is that language's share when evidence is
    weighed per character, as if a text had at most ``FULL_LENGTH`` of them; 0 for
    ``und``. ``accepted`` is false for ``und`` and for texts that need more nats per
    character than texts of their language do. Columns with the new names are replaced.
    Repeated rows and rows without an id are each predicted; an empty table gives no rows.
    """
    rows = docs.drop("held_out", "lang_pred", "score", "accepted")
    kept_fields = [f for f in rows.schema.fields if f.name != "text"]
    stored = isinstance(models, StoredModels)
    given = _scored(rows, models) if stored else rows
    langs, limits = models.langs, models.limits
    held = None if stored else sent(docs.sparkSession, models)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            if stored:
                nats = np.zeros((batch.num_rows, len(langs)))
                for r, found in enumerate(batch.column(names.index("_nats")).to_pylist()):
                    if found is not None:
                        nats[r] = found
                lengths = np.asarray(batch.column(names.index("_length")))
                decided = _judged(nats, lengths, langs, limits)
            else:
                decided = _decide([t or "" for t in text_of(batch).to_pylist()], held.value)
                give_back_memory()
            kept = [(n, batch.column(i)) for i, n in enumerate(names) if n not in ("text", "_nats", "_length")]
            yield pa.RecordBatch.from_arrays(
                [*[c for _, c in kept], pa.array(decided[0], pa.string()), *map(pa.array, decided[1:])],
                names=[*[n for n, _ in kept], "lang_pred", "score", "accepted"],
            )

    schema = ", ".join(
        [
            *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept_fields],
            "lang_pred string, score double, accepted boolean",
        ]
    )
    return given.mapInArrow(apply, schema).withColumn(
        "held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT
    )


def _decide(texts: list[str], models: LanguageModels) -> tuple[list[str], np.ndarray, np.ndarray]:
    if not models.known:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    nats, lengths = cross_entropies(texts, models)
    return _judged(nats, lengths, models.langs, models.limits)


def _judged(
    nats: np.ndarray, lengths: np.ndarray, langs: list[str], limits: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray]:
    best = nats.argmin(1) if len(nats) else np.zeros(0, np.int64)
    lowest = nats[np.arange(len(nats)), best]
    weight = np.minimum(lengths, FULL_LENGTH)[:, None]
    share = 1 / np.exp(np.minimum((lowest[:, None] - nats) * weight, 0)).sum(1)
    some = lengths > 0
    slack = MARGIN * np.sqrt(FULL_LENGTH / np.clip(lengths, 1, FULL_LENGTH)) - MARGIN
    usual = limits[best, np.searchsorted(LENGTH_CLASSES, lengths, "right")]
    accepted = some & (lowest <= usual + slack)
    named = [langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
    return named, np.where(some, share, 0.0), accepted
