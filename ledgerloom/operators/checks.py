"""Data-quality checks that yield their results as tables.

Each report folds all its measures into one aggregate over the checked table and
turns the single result row into check rows with ``inline``, so nothing is counted
twice and nothing comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.checksums import (
    checksum_text,
    fingerprint,
    hash_sum_lanes,
    merge_lanes,
)

PASS, FAIL, SKIP = "PASS", "FAIL", "SKIP"


class ChecksFailed(RuntimeError):
    """Raised on request when a report holds failed checks."""


@dataclass(frozen=True)
class AuditSpec:
    """What the audit of one target table looks at."""

    keys: tuple[str, ...]
    checksum_columns: tuple[str, ...]
    contract: T.StructType
    source_valid: str
    source_label: str
    target_label: str
    key_prefixes: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


def _verdict(passed: Column) -> Column:
    return F.when(passed, F.lit(PASS)).otherwise(F.lit(FAIL))


def _check(name: str, status: Column | str, *details: Column | str) -> Column:
    parts = [F.lit(d) if isinstance(d, str) else d.cast("string") for d in details]
    return F.struct(
        F.lit(name).alias("CHECK_NAME"),
        (F.lit(status) if isinstance(status, str) else status).alias("STATUS"),
        F.concat(*parts).alias("DETAILS"),
    )


def _any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


# --- counts -----------------------------------------------------------------


def count_rows(df: DataFrame) -> DataFrame:
    """One row, one column ``row_count``."""
    return df.agg(F.count("*").alias("row_count"))


def count_snapshot(df: DataFrame, run_date: str) -> DataFrame:
    """Row count stamped with an ISO run date, ready to be appended as JSON."""
    return count_rows(df).withColumn("run_date", F.lit(run_date))


def column_bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def null_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which any key column is null."""
    return df.agg(F.count_if(_any_null(keys)).alias("null_rows"))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and rate per column; the rate of an empty table is null."""
    counts = df.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col("row_count").alias("row_count"),
            (
                F.col(f"nulls_{i}").cast("double")
                / F.nullif(F.col("row_count"), F.lit(0)).cast("double")
            ).alias("null_rate"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


# --- contracts and rules -----------------------------------------------------


def missing_columns(df: DataFrame, contract: T.StructType) -> list[str]:
    return sorted(set(contract.names) - set(df.columns))


def wrong_types(df: DataFrame, contract: T.StructType) -> list[str]:
    """Columns of another type than the contract's, as ``name is type, not type``."""
    return [
        f"{f.name} is {df.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
        for f in contract.fields
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    ]


def schema_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per column: OK, MISSING, TYPE_MISMATCH or EXTRA, with offending rows.

    A row offends when it is null in a non-nullable column or cannot be cast to
    the contract's type.
    """
    measures: list[Column] = [F.count("*").alias("row_count")]
    rows: list[tuple[str, str, str, str | None]] = []
    for i, want in enumerate(contract.fields):
        expected = want.dataType.simpleString()
        if want.name not in df.columns:
            rows.append((want.name, "MISSING", expected, None))
            continue
        value = F.col(want.name)
        same = df.schema[want.name].dataType == want.dataType
        tests = []
        if not want.nullable:
            tests.append(value.isNull())
        if not same:
            tests.append(value.isNotNull() & value.try_cast(want.dataType).isNull())
        measure = None
        if tests:
            measure = f"offending_{i}"
            measures.append(F.count_if(reduce(lambda a, b: a | b, tests)).alias(measure))
        rows.append((want.name, "OK" if same else "TYPE_MISMATCH", expected, measure))
    for name in sorted(set(df.columns) - set(contract.names)):
        rows.append((name, "EXTRA", "", None))

    entries = []
    for name, status, expected, measure in rows:
        actual = df.schema[name].dataType.simpleString() if name in df.columns else ""
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(status).alias("status"),
                F.lit(expected).alias("expected_type"),
                F.lit(actual).alias("actual_type"),
                (F.col(measure) if measure else F.lit(0).cast("bigint")).alias("offending_rows"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*entries)))


@dataclass(frozen=True)
class Constraint:
    """A named SQL predicate every row should meet; ``allow_null`` rates an unknown result."""

    name: str
    predicate: str
    allow_null: bool = False


def constraint_report(df: DataFrame, constraints: Iterable[Constraint]) -> DataFrame:
    """Violations per constraint, all measured in one pass."""
    rules = list(constraints)
    counts = df.agg(
        F.count("*").alias("row_count"),
        *[
            F.count_if(~F.coalesce(F.expr(r.predicate), F.lit(r.allow_null))).alias(f"bad_{i}")
            for i, r in enumerate(rules)
        ],
    )
    entries = [
        F.struct(
            F.lit(r.name).alias("constraint_name"),
            _verdict(F.col(f"bad_{i}") == 0).alias("status"),
            F.col(f"bad_{i}").alias("violations"),
            F.col("row_count").alias("row_count"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


# --- audit of a relationship table -------------------------------------------


def _bare_prefix(spec: AuditSpec) -> Column:
    """Whether a key is nothing but the hash of one of its prefixes."""
    return reduce(
        lambda a, b: a | b,
        [
            F.col(name).isin(*[F.sha2(F.lit(p), 256) for p in prefixes])
            for name, prefixes in spec.key_prefixes.items()
        ],
    )


def _has(df: DataFrame, names: Iterable[str]) -> bool:
    return all(n in df.columns for n in names)


def _total(condition_or_count: Column) -> Column:
    return F.coalesce(F.sum(condition_or_count), F.lit(0))


def _target_metrics(target: DataFrame, spec: AuditSpec, method: str) -> DataFrame:
    """One row of measures: a keyed aggregate, then an aggregate over the groups.

    The first level combines on the map side, so a key held by a large share of
    the rows costs one partial row per task.
    """
    keyed, summed = _has(target, spec.keys), _has(target, spec.checksum_columns)
    rows = target.select(
        *(spec.keys if keyed else ()),
        *([fingerprint(spec.checksum_columns, method).alias("fingerprint")] if summed else []),
    )
    lanes = hash_sum_lanes("fingerprint") if summed else []
    if not keyed:
        return rows.agg(F.count("*").alias("target_rows"), *lanes)

    groups = rows.groupBy(*spec.keys).agg(F.count("*").alias("n"), *lanes)
    measures = [
        _total(F.col("n")).alias("target_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        _total(F.when(_any_null(spec.keys), F.col("n"))).alias("null_rows"),
    ]
    if spec.key_prefixes:
        measures.append(_total(F.when(_bare_prefix(spec), F.col("n"))).alias("collapsed_rows"))
    return groups.agg(*measures, *(merge_lanes() if summed else []))


def duplicate_key_count(
    target: DataFrame, keys: Sequence[str], suspects: DataFrame
) -> DataFrame:
    """Exact number of repeated keys among rows whose key hash is a suspect."""
    hashed = target.select(*keys, F.xxhash64(*keys).alias("key_hash"))
    return (
        hashed.join(suspects, "key_hash", "left_semi")
        .groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    )


def measured_rows(target: DataFrame, spec: AuditSpec, method: str, *kept: str) -> DataFrame:
    """What an audit needs of each row in place of its keys: a 64-bit hash of them, marks
    of null and bare ones, and the row's fingerprint; beside the columns ``kept``."""
    return target.select(
        *kept,
        F.xxhash64(*spec.keys).alias("key_hash"),
        F.when(_any_null(spec.keys), 1).otherwise(0).alias("null_key"),
        (F.when(_bare_prefix(spec), 1).otherwise(0) if spec.key_prefixes else F.lit(0)).alias(
            "bare_key"
        ),
        fingerprint(spec.checksum_columns, method).alias("fingerprint"),
    )


def _prescreened_metrics(target: DataFrame, spec: AuditSpec, method: str) -> DataFrame:
    """The same measures with a narrow shuffle: 64-bit key hashes instead of the keys.

    Rows with equal keys have equal hashes, so a table without a repeated hash has
    no repeated key. Hashes that do repeat are suspects, and only their rows are
    grouped by the keys themselves. Runs one job to learn how many there are.
    """
    rows = measured_rows(target, spec, method)
    groups = rows.groupBy("key_hash").agg(
        F.count("*").alias("n"),
        F.sum("null_key").alias("null_key"),
        F.sum("bare_key").alias("bare_key"),
        *hash_sum_lanes("fingerprint"),
    )
    found = groups.agg(
        _total(F.col("n")).alias("target_rows"),
        F.count_if(F.col("n") > 1).alias("suspects"),
        _total(F.col("null_key")).alias("null_rows"),
        _total(F.col("bare_key")).alias("collapsed_rows"),
        *merge_lanes(),
    ).first()
    spark = target.sparkSession
    measured = spark.range(1).select(
        *[
            F.lit(value).cast("bigint").alias(name)
            for name, value in found.asDict().items()
            if name != "suspects"
        ]
    )
    if not found["suspects"]:
        return measured.withColumn("duplicate_keys", F.lit(0).cast("bigint"))
    suspects = (
        target.groupBy(F.xxhash64(*spec.keys).alias("key_hash"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .select("key_hash")
    )
    exact = duplicate_key_count(target, spec.keys, suspects)
    return measured.withColumn("duplicate_keys", exact.scalar())


def audit_links(
    target: DataFrame,
    source: DataFrame,
    spec: AuditSpec,
    checksum_method: str = "xxhash64",
    expected_rows: DataFrame | None = None,
    expected_checksum: str | None = None,
    stamped: bool = True,
    prescreen: bool = False,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """Check rows (CHECK_NAME, STATUS, DETAILS, CHECK_TIMESTAMP) for a target table.

    Five checks are always reported. Row Count judges the target only and Hash
    Checksum cannot fail by itself; the stricter forms are added on request:
    ``expected_rows`` (a one-column, one-row DataFrame) adds Expected Rows,
    ``expected_checksum`` adds Expected Checksum, and key prefixes in the spec add
    Collapsed Key, which counts ids made of the bare prefix of a null key. Checks
    whose columns are missing are reported as SKIP.

    The measures take one pass and one shuffle of the keys. ``prescreen`` looks for
    repeated 64-bit key hashes first, which shuffles about a third as much and
    leaves the keys themselves to be compared only where hashes repeat; it starts a
    job while the report is being built. ``metrics`` takes the target's measures as one row
    made elsewhere; only the target's schema is looked at then.
    """
    missing = missing_columns(target, spec.contract)
    unlike = [f"Missing Columns: {missing}"] if missing else []
    types = wrong_types(target, spec.contract)
    if types:
        unlike.append(f"Wrong Types: {types}")
    keyed, summed = _has(target, spec.keys), _has(target, spec.checksum_columns)
    skipped = f"Skipped, missing columns: {missing}"

    source_rows = source.filter(F.expr(spec.source_valid)).agg(F.count("*").alias("n"))
    if metrics is None:
        measure = _prescreened_metrics if prescreen and keyed and summed else _target_metrics
        metrics = measure(target, spec, checksum_method)
    metrics = metrics.withColumn("source_rows", source_rows.scalar())
    if expected_rows is not None:
        metrics = metrics.withColumn("expected_rows", expected_rows.scalar())

    rows, label = F.col("target_rows"), spec.target_label
    # Check names and detail texts are fixed values.
    checks = [
        _check(
            "Row Count",
            _verdict(rows > 0),
            f"{spec.source_label}: ", F.col("source_rows"), f", {label} Rows: ", rows,
        )
    ]
    if keyed:
        duplicates, nulls = F.col("duplicate_keys"), F.col("null_rows")
        checks += [
            _check(
                "Duplicate Key",
                _verdict(duplicates == 0),
                "Found ", duplicates, f" duplicate ({', '.join(spec.keys)}) pairs in {label}",
            ),
            _check(
                "Null Key",
                _verdict(nulls == 0),
                "Found ", nulls, f" records with null {' or '.join(spec.keys)}",
            ),
        ]
    else:
        checks += [_check(name, SKIP, skipped) for name in ("Duplicate Key", "Null Key")]

    checksum = checksum_text(rows) if summed else None
    if checksum is None:
        checks.append(_check("Hash Checksum", SKIP, skipped))
    else:
        checks.append(
            _check("Hash Checksum", _verdict(checksum != ""), f"{label} Checksum: ", checksum)
        )
    checks.append(
        _check(
            "Schema Validation",
            FAIL if unlike else PASS,
            "; ".join(unlike) or "Schema matches 100%",
        )
    )

    if spec.key_prefixes:
        if keyed:
            collapsed = F.col("collapsed_rows")
            checks.append(
                _check(
                    "Collapsed Key",
                    _verdict(collapsed == 0),
                    "Found ", collapsed, " records keyed on a bare prefix",
                )
            )
        else:
            checks.append(_check("Collapsed Key", SKIP, skipped))
    if expected_rows is not None:
        expected = F.coalesce(F.col("expected_rows"), F.lit(0))
        checks.append(
            _check(
                "Expected Rows",
                _verdict(rows == expected),
                "Expected Rows: ", expected, f", {label} Rows: ", rows,
            )
        )
    if expected_checksum is not None:
        if checksum is None:
            checks.append(_check("Expected Checksum", SKIP, skipped))
        else:
            checks.append(
                _check(
                    "Expected Checksum",
                    _verdict(checksum == expected_checksum),
                    f"Expected: {expected_checksum}, {label}: ", checksum,
                )
            )

    report = metrics.select(F.inline(F.array(*checks)))
    return report.withColumn("CHECK_TIMESTAMP", F.current_timestamp()) if stamped else report


def raise_on_failures(report: DataFrame, status: str = "STATUS", name: str = "CHECK_NAME") -> None:
    """Raise :class:`ChecksFailed` naming the failed checks; a report has one row per check."""
    failed = [r[name] for r in report.filter(F.col(status) == FAIL).select(name).collect()]
    if failed:
        raise ChecksFailed(f"{len(failed)} checks failed: {', '.join(sorted(failed))}")
