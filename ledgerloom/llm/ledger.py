"""Quality rules as a ledger of bits: measured and judged once, decided by versioned policies.

Every rule is evaluated once per document. The ledger keeps what was measured and one
number whose bit i is set where rule i fails. A policy is a mask over those bits, so a
new policy, and what each of its rules costs, are read off the ledger without a look at
any text. All of it is built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_PATTERN

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# Words of a window in which repetition is looked for.
WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_letters", "n_upper", "n_letter_words", "n_stutter",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measures; whole numbers only, so that it is exact anywhere."""

    name: str
    fails: str


# A rule's place is its bit for good: new rules go to the end, and none is taken out.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("capitals", "100 * n_upper > 60 * n_letters AND n_letters > 0"),
    Rule("words_without_letters", "100 * n_letter_words < 70 * n_words"),
    Rule("stutter", "100 * n_stutter > 15 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """The rules that count, and how many of them a kept document may fail."""

    version: str
    rules: tuple[str, ...]
    tolerated: int = 0

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        names = [r.name for r in rules]
        unknown = sorted(set(self.rules) - set(names))
        if unknown:
            raise ValueError(f"policy {self.version} names unknown rules {unknown}")
        return sum(1 << names.index(name) for name in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = (
    BASE,
    Policy("prose-1", (*BASE.rules, "symbols", "repeated_lines")),
    Policy("prose-2", tuple(r.name for r in RULES)),
)
CURRENT = POLICIES[-1]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, also where functions over items need it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside windows that the text holds twice or more.

    Texts whose windows have distinct hashes have no repeat, which settles nearly all of
    them. In the rest, windows are sorted by hash and compared word by word with their
    neighbours; the starts of those that repeat are walked in order, and each covers the
    words up to the next start, a window's length at most.
    """

    def windows(item: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), item)

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce((a["hash"] == b["hash"]) & (a["window"] == b["window"]), F.lit(False))

    def covered(ordered: Column) -> Column:
        repeated = F.filter(
            ordered,
            lambda x, i: equal(x, F.get(ordered, i - 1)) | equal(x, F.get(ordered, i + 1)),
        )
        return _bound(
            F.sort_array(F.transform(repeated, lambda x: x["start"])),
            lambda starts: F.aggregate(
                F.transform(
                    starts,
                    lambda at, i: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))
                    ),
                ),
                F.lit(0),
                lambda total, more: total + more,
            ),
        )

    def among(hashes: Column) -> Column:
        located = windows(
            lambda i: _bound(
                F.slice(words, i, WINDOW),
                lambda w: F.struct(
                    F.xxhash64(w).alias("hash"), w.alias("window"), i.alias("start")
                ),
            )
        )
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            _bound(F.sort_array(located), covered),
        ).otherwise(F.lit(0))

    hashes = windows(lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) > WINDOW, _bound(hashes, among)).otherwise(F.lit(0))


def _measured(text: Column) -> Column:
    """A struct of all measures of a text that is not null."""

    def of_words(words: Column) -> list[Column]:
        stutter = F.filter(words, lambda w, i: w == F.get(words, i - 1))
        return [
            F.size(words).alias("n_words"),
            F.char_length(F.array_join(words, "")).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.rlike(w, F.lit(r"\p{L}")))).alias("n_letter_words"),
            F.size(stutter).alias("n_stutter"),
        ]

    def of_lines(lines: Column) -> list[Column]:
        return [
            F.size(lines).alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        ]

    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD_PATTERN)))
    return F.struct(
        _bound(words, lambda w: F.struct(*of_words(w))).alias("words"),
        _bound(lines, lambda x: F.struct(*of_lines(x))).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{L}")).alias("n_letters"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"),
    )


def failure_bits(rules: Sequence[Rule]) -> Column:
    """One number with the bit of every rule that fails; a measure that is null fails none."""
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        for i, rule in enumerate(rules)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))


def rule_ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, the measures and ``failed``, a row per row of ``docs``.

    Words are runs without white space. Lines end at line feeds, and only lines with a
    word count: one equal to an earlier line of its text is a duplicate. A null text has
    no words and no lines. Nothing is shuffled, so repeated rows and null ids are rows of
    their own, and a text of any length costs its own task alone. Other columns are not
    read. No rows give no rows.
    """
    measured = docs.select("doc_id", _measured(F.coalesce(F.col("text"), F.lit(""))).alias("m"))
    places = {c: f"m.{c}" for c in ("n_symbols", "n_letters", "n_upper")}
    places |= {c: f"m.lines.{c}" for c in ("n_lines", "n_dup_lines")}
    named = [F.col(places.get(c, f"m.words.{c}")).cast("long").alias(c) for c in MEASURES]
    return measured.select("doc_id", *named).withColumn("failed", failure_bits(rules))


def with_verdict(
    ledger: DataFrame, policy: Policy = CURRENT, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger with ``policy`` (its version) and ``kept``; no text is looked at."""
    counted = F.bit_count(F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")))
    return ledger.withColumns(
        {"policy": F.lit(policy.version), "kept": counted <= policy.tolerated}
    )


def ablations(
    ledger: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """What every rule of every policy does, in one pass over the ledger.

    ``policy``, ``rule``, ``n_docs``, ``n_kept`` by the policy, ``n_failing`` the rule,
    ``n_kept_without`` it, and ``n_only``: documents the policy drops that it would keep
    without this rule. Rows are first counted per distinct value of ``failed``, on the
    map side, so what is shuffled depends on the rules and not on the documents. An
    empty ledger gives no rows.
    """
    seen = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("docs"))
    cases = F.array(
        *[
            F.struct(
                F.lit(p.version).alias("policy"),
                F.lit(r.name).alias("rule"),
                F.lit(p.mask(rules)).cast("long").alias("mask"),
                F.lit(1 << i).cast("long").alias("bit"),
                F.lit(p.tolerated).alias("tolerated"),
            )
            for p in policies
            for i, r in enumerate(rules)
            if r.name in p.rules
        ]
    )
    each = seen.select("failed", "docs", F.explode(cases).alias("case")).select(
        "failed", "docs", "case.*"
    )
    counted = F.bit_count(F.col("failed").bitwiseAND(F.col("mask")))
    without = F.bit_count(
        F.col("failed").bitwiseAND(F.col("mask")).bitwiseAND(F.bitwise_not(F.col("bit")))
    )
    kept, kept_without = counted <= F.col("tolerated"), without <= F.col("tolerated")

    def docs_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("docs")).otherwise(F.lit(0).cast("long")))

    return each.groupBy("policy", "rule").agg(
        F.sum("docs").alias("n_docs"),
        docs_where(kept).alias("n_kept"),
        docs_where(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failing"),
        docs_where(kept_without).alias("n_kept_without"),
        docs_where(kept_without & ~kept).alias("n_only"),
    )
