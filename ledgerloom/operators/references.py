"""Rules between tables: every child row has its parent, every parent key stands once.

Child and parent keys are counted together, by union and aggregate: a key held by a third
of the child's rows is one partial row per task, and repeated parents multiply nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.checks import FAIL, PASS


@dataclass(frozen=True)
class Reference:
    """Columns of a child table that name a row of a parent table.

    A child row with a null among the columns names none: that breaks the rule unless
    ``allow_null``. Keys are compared as the parent's types.
    """

    name: str
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    allow_null: bool = True

    def __post_init__(self):
        if not self.columns or len(self.columns) != len(self.parent_columns):
            raise ValueError(f"{self.name}: as many child columns as parent columns are needed")


def _child_keys(child: DataFrame, parent: DataFrame, rule: Reference) -> list[Column]:
    """The child's key in the parent's types; what cannot be cast names no parent."""
    return [
        child[c] if child.schema[c].dataType == parent.schema[p].dataType
        else child[c].try_cast(parent.schema[p].dataType)
        for c, p in zip(rule.columns, rule.parent_columns)
    ]


def _any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def key_usage(child: DataFrame, parent: DataFrame, rule: Reference) -> DataFrame:
    """Per key: ``child_rows``, ``null_rows`` of them without a whole key, ``parent_rows``."""
    names = [f"key_{i}" for i in range(len(rule.columns))]
    used = child.select(
        *[k.alias(n) for k, n in zip(_child_keys(child, parent, rule), names)],
        F.lit(1).cast("bigint").alias("child_rows"),
        F.when(_any_null(rule.columns), 1).otherwise(0).cast("bigint").alias("null_rows"),
        F.lit(0).cast("bigint").alias("parent_rows"),
    )
    given = parent.select(
        *[F.col(c).alias(n) for c, n in zip(rule.parent_columns, names)],
        F.lit(0).cast("bigint").alias("child_rows"),
        F.lit(0).cast("bigint").alias("null_rows"),
        F.lit(1).cast("bigint").alias("parent_rows"),
    )
    return used.unionAll(given).groupBy(*names).agg(
        *[F.sum(c).alias(c) for c in ("child_rows", "null_rows", "parent_rows")]
    )


def referential_report(tables: dict[str, DataFrame], rules: Sequence[Reference]) -> DataFrame:
    """A row per rule; one shuffle of keys each.

    ``orphan_rows`` and ``orphan_keys`` name no parent, ``null_rows`` have no whole key,
    ``repeated_parents`` are keys of more than one parent row and ``unused_parents`` whole
    keys no child names. A rule passes without orphans, repeated parents and, unless
    allowed, nulls. A null in a parent's key makes it nobody's parent.
    """
    reports = []
    for rule in rules:
        child, parent = tables[rule.child], tables[rule.parent]
        names = [f"key_{i}" for i in range(len(rule.columns))]
        whole, named = ~_any_null(names), F.col("child_rows") - F.col("null_rows")
        alone = (named > 0) & ~(whole & (F.col("parent_rows") > 0))
        found = key_usage(child, parent, rule).agg(
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("child_rows"),
            F.coalesce(F.sum("null_rows"), F.lit(0)).alias("null_rows"),
            F.coalesce(F.sum(F.when(alone, named)), F.lit(0)).alias("orphan_rows"),
            F.count_if(alone).alias("orphan_keys"),
            F.count_if(whole & (F.col("parent_rows") > 1)).alias("repeated_parents"),
            F.count_if(whole & (F.col("parent_rows") > 0) & (named == 0)).alias("unused_parents"),
        )
        good = (F.col("orphan_rows") == 0) & (F.col("repeated_parents") == 0)
        if not rule.allow_null:
            good = good & (F.col("null_rows") == 0)
        status = F.when(good, PASS).otherwise(FAIL)
        reports.append(found.select(F.lit(rule.name).alias("rule_name"), status.alias("status"), "*"))
    return reduce(lambda a, b: a.unionAll(b), reports)


def orphan_rows(child: DataFrame, parent: DataFrame, rule: Reference) -> DataFrame:
    """Child rows the rule is broken by, whole and as they came.

    Missing keys are found by counting, so the join that fetches their rows has only them
    on its other side: nothing but a scan of the child where none is missing.
    """
    names = [f"key_{i}" for i in range(len(rule.columns))]
    missing = (
        key_usage(child, parent, rule)
        .filter((F.col("parent_rows") == 0) | _any_null(names))
        .filter(F.col("child_rows") > F.col("null_rows"))
        .select(*[F.col(n).alias(f"_missing_{n}") for n in names])
    )
    met = reduce(
        lambda a, b: a & b,
        [
            key.eqNullSafe(missing[f"_missing_{n}"])
            for key, n in zip(_child_keys(child, parent, rule), names)
        ],
    )
    null = _any_null(rule.columns)
    orphans = child.filter(~null).join(missing, met, "left_semi")
    return orphans if rule.allow_null else orphans.unionAll(child.filter(null))
