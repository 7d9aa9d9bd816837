"""Clean-up between raw and staging: metadata, casts, null tokens, duplicates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts read as null during staging (fixed values, overridable per rule).
NULL_TOKENS = ("", "N/A", "NA", "NULL", "NONE", "-")
DATE_FORMATS = ("yyyy-MM-dd", "yyyyMMdd", "dd/MM/yyyy")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy HH:mm:ss")


def with_etl_date(df: DataFrame, run_date: str) -> DataFrame:
    """Set ETL_DATE to the run date text, replacing a column of that name."""
    return df.withColumn("ETL_DATE", F.lit(run_date))


def with_ingest_metadata(df: DataFrame, run_date: str) -> DataFrame:
    """Add ETL_DATE and INGESTION_TIMESTAMP; the timestamp is one value per write."""
    return with_etl_date(df, run_date).withColumn("INGESTION_TIMESTAMP", F.current_timestamp())


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct full rows. Copies are combined per task before the shuffle."""
    return df.dropDuplicates()


def stack_versions(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of tables whose columns changed over time; absent ones become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _digit_shape(pattern: str) -> str | None:
    """Regular expression for texts of an all-digit format; None for any other format."""
    if "''" in pattern or set(pattern) & set("[]{}#"):
        return None
    shape = "^"
    for quoted, letters, other in re.findall(r"'([^']*)'|([A-Za-z]+)|([^A-Za-z'])", pattern):
        if not letters:
            shape += re.escape(quoted or other)
            continue
        for run in re.findall(r"((.)\2*)", letters):
            if run[1] not in "yMdHhmsS" or len(run[0]) < 2 or run[0] == "yyy" or "MMM" in run[0]:
                return None
            shape += f"[0-9]{{{len(run[0])}}}"
    return shape + "$"


def _parsed(text: Column, pattern: str) -> Column:
    """Text read in one format, else null.

    A failed parse costs an exception inside the parser, so texts of another shape
    are not handed to it.
    """
    value, shape = F.try_to_timestamp(text, F.lit(pattern)), _digit_shape(pattern)
    return F.when(text.rlike(shape), value) if shape else value


@dataclass(frozen=True)
class ColumnRule:
    """How one staging column is made from a raw one.

    ``type`` is a Spark SQL type. Dates and timestamps are tried against each of
    ``formats`` in turn. ``source`` is the raw column where its name differs.
    """

    name: str
    type: str = "string"
    source: str | None = None
    formats: tuple[str, ...] = ()
    null_tokens: tuple[str, ...] = NULL_TOKENS
    required: bool = False

    @property
    def raw_name(self) -> str:
        return self.source or self.name

    def cleaned(self) -> Column:
        """Trimmed text, null where it is one of the null tokens in any letter case."""
        text = F.trim(F.col(self.raw_name).cast("string"))
        tokens = sorted({t.upper() for t in self.null_tokens})
        return F.when(~F.upper(text).isin(*tokens), text) if tokens else text

    def value(self) -> Column:
        text, kind = self.cleaned(), self.type.lower()
        if kind == "string":
            return text
        if kind in ("date", "timestamp", "timestamp_ntz"):
            default = DATE_FORMATS if kind == "date" else TIMESTAMP_FORMATS
            tries = [_parsed(text, f) for f in self.formats or default]
            return F.coalesce(*tries).cast(kind)
        return text.try_cast(self.type)

    def problem(self) -> Column:
        """Why a row cannot be staged, or null."""
        unreadable = self.cleaned().isNotNull() & self.value().isNull()
        reason = F.when(unreadable, F.lit(f"{self.name}: not a {self.type}"))
        if self.required:
            reason = reason.when(self.cleaned().isNull(), F.lit(f"{self.name}: required"))
        return reason


REJECT_REASON = "REJECT_REASON"


def reject_reason(rules: Sequence[ColumnRule]) -> Column:
    """All problems of a row in one text, empty for a good row."""
    return F.concat_ws("; ", *[r.problem() for r in rules])


def _staged_columns(df: DataFrame, rules: Sequence[ColumnRule], keep_rest: bool) -> list[Column]:
    used = {r.raw_name for r in rules} | {r.name for r in rules}
    rest = [F.col(c) for c in df.columns if c not in used] if keep_rest else []
    return [*[r.value().alias(r.name) for r in rules], *rest]


def normalise(df: DataFrame, rules: Sequence[ColumnRule], keep_rest: bool = True) -> DataFrame:
    """Apply the rules; values that cannot be read become null."""
    return df.select(*_staged_columns(df, rules, keep_rest))


def judged(df: DataFrame, rules: Sequence[ColumnRule], keep_rest: bool = True) -> DataFrame:
    """Normalised rows, good and bad, with REJECT_REASON."""
    return df.select(
        *_staged_columns(df, rules, keep_rest), reject_reason(rules).alias(REJECT_REASON)
    )


def quarantined(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """The bad rows as they came, with REJECT_REASON."""
    return df.withColumn(REJECT_REASON, reject_reason(rules)).filter(F.col(REJECT_REASON) != "")


def quarantine_split(
    df: DataFrame, rules: Sequence[ColumnRule], keep_rest: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(normalised good rows, raw bad rows with REJECT_REASON); together they are all rows."""
    good = judged(df, rules, keep_rest).filter(F.col(REJECT_REASON) == "").drop(REJECT_REASON)
    return good, quarantined(df, rules)


def split_by_rule(df: DataFrame, predicate: str) -> tuple[DataFrame, DataFrame]:
    """(rows meeting a SQL predicate, all other rows); unknown counts as not met."""
    met = F.coalesce(F.expr(predicate), F.lit(False))
    return df.filter(met), df.filter(~met)
