"""Hash-keyed relationship mapping driven by declarative specs.

A spec says, per source table, which rows are valid and which relationship blocks
each valid row yields. Mapping is a narrow transformation, scan to sink without a
shuffle. All selected blocks of one source share one scan: a row is fanned out
over the block numbers it qualifies for and keyed afterwards, so the source is
read once and the arrangement key is hashed once per source row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import composite_value, surrogate_key

ALL_BLOCKS = "all"

LINK_SCHEMA = T.StructType(
    [
        T.StructField("AR_ID", T.StringType(), False),
        T.StructField("SRC_STM_ID", T.StringType(), False),
        T.StructField("AU_ID", T.StringType(), False),
        T.StructField("AR_X_AU_RLTNP_TP_ID", T.StringType(), False),
        T.StructField("PPN_DT", T.DateType(), False),
        T.StructField("EFF_DT", T.DateType(), True),
        T.StructField("END_DT", T.DateType(), False),
    ]
)


@dataclass(frozen=True)
class KeyRule:
    """How one surrogate key is built: prefix, joined columns, suffix."""

    prefix: str
    columns: tuple[str, ...]
    joiner: str = "."
    suffix: str = ""

    def value(self) -> Column:
        return composite_value(self.columns, self.joiner, self.suffix)

    def has_null(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns])


@dataclass(frozen=True)
class Block:
    """One relationship type a source row can yield."""

    block_id: str
    relationship: str
    unit: KeyRule
    where: str | None = None


@dataclass(frozen=True)
class LinkSource:
    """A source table, its validity rule and its blocks.

    ``optional_equals`` holds (column, value) filters that apply only where the
    column exists. ``effective_from`` names the date column an opening run uses;
    without one, rows are effective from the run date.
    """

    table: str
    system: str
    arrangement: KeyRule
    valid: str
    blocks: tuple[Block, ...]
    optional_equals: tuple[tuple[str, str], ...] = ()
    effective_from: str | None = None


@dataclass(frozen=True)
class LinkSpec:
    """A complete relationship table."""

    name: str
    sources: tuple[LinkSource, ...]
    system_prefix: str
    relationship_prefix: str
    opening_run_types: tuple[str, ...]
    run_types: tuple[str, ...]
    end_date: str
    allow_decimal_keys: bool = False

    def __post_init__(self) -> None:
        ids = self.block_ids()
        if len(ids) != len(set(ids)):
            raise ValueError(f"block ids repeat in {self.name}: {ids}")
        prefixes = sorted(set(self.prefixes()))
        for shorter in prefixes:
            for longer in prefixes:
                if shorter != longer and longer.startswith(shorter):
                    raise ValueError(f"key prefix {shorter!r} is the start of {longer!r}")

    def block_ids(self) -> list[str]:
        return [b.block_id for s in self.sources for b in s.blocks]

    def prefixes(self) -> list[str]:
        found = [self.system_prefix, self.relationship_prefix]
        for source in self.sources:
            found.append(source.arrangement.prefix)
            found.extend(b.unit.prefix for b in source.blocks)
        return found

    def system_key(self, source: LinkSource) -> Column:
        return surrogate_key(self.system_prefix, F.lit(source.system))

    def relationship_key(self, block: Block) -> Column:
        return surrogate_key(self.relationship_prefix, F.lit(block.relationship))

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)

    @classmethod
    def from_json(cls, text: str) -> LinkSpec:
        """Read a mapping file written by :meth:`to_json` or by hand."""
        raw = json.loads(text)

        def rule(item: dict) -> KeyRule:
            return KeyRule(**{**item, "columns": tuple(item["columns"])})

        sources = []
        for item in raw["sources"]:
            blocks = tuple(Block(**{**b, "unit": rule(b["unit"])}) for b in item["blocks"])
            sources.append(
                LinkSource(
                    **{
                        **item,
                        "arrangement": rule(item["arrangement"]),
                        "blocks": blocks,
                        "optional_equals": tuple(tuple(p) for p in item.get("optional_equals", ())),
                    }
                )
            )
        return cls(
            **{
                **raw,
                "sources": tuple(sources),
                "opening_run_types": tuple(raw["opening_run_types"]),
                "run_types": tuple(raw["run_types"]),
            }
        )


def select_blocks(spec: LinkSpec, blocks: str | Iterable[str] = ALL_BLOCKS) -> set[str]:
    """Resolve ``"all"``, a comma list or an iterable of ids; unknown ids raise."""
    known = set(spec.block_ids())
    if isinstance(blocks, str):
        if blocks.strip().lower() == ALL_BLOCKS:
            return known
        blocks = blocks.split(",")
    chosen = {str(b).strip() for b in blocks} - {""}
    unknown = sorted(chosen - known)
    if unknown:
        raise ValueError(f"unknown blocks {unknown} for {spec.name}; known are {sorted(known)}")
    if not chosen:
        raise ValueError(f"no blocks selected for {spec.name}")
    return chosen


def parse_run_date(run_date: str) -> Column:
    """A ``yyyyMMdd`` run date as a date literal; anything else raises."""
    if len(run_date) != 8 or not run_date.isdigit():
        raise ValueError(f"run date {run_date!r} is not of the form yyyyMMdd")
    return F.lit(datetime.strptime(run_date, "%Y%m%d").date())


def as_lenient_date(df: DataFrame, name: str) -> Column:
    """The column as a date; text that is not a date becomes null."""
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return F.try_to_date(F.col(name).cast("string"))


def valid_rows(df: DataFrame, source: LinkSource) -> DataFrame:
    """The rows of a source that may yield links; a null flag drops the row."""
    rows = df.filter(F.expr(source.valid))
    for name, value in source.optional_equals:
        if name in df.columns:
            rows = rows.filter(F.col(name) == value)
    return rows


def _require_stable_key_types(df: DataFrame, spec: LinkSpec, rule: KeyRule) -> None:
    for name in rule.columns:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            raise TypeError(f"{name} is {kind.simpleString()}: its text form is no stable key")
        if isinstance(kind, T.TimestampType):
            raise TypeError(
                f"{name} is timestamp: its text changes with the session's time zone; "
                "cast it to timestamp_ntz, date or string"
            )
        if isinstance(kind, T.DecimalType) and kind.scale and not spec.allow_decimal_keys:
            raise TypeError(
                f"{name} is {kind.simpleString()}: cast it to an integral type or string, "
                "or set allow_decimal_keys to hash its padded decimal text"
            )


def _any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _by_block(number: Column, values: list[Column]) -> Column:
    """CASE over the block number; one distinct value needs none."""
    if len(values) == 1:
        return values[0]
    choice = F.when(number == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        choice = choice.when(number == i, value)
    return choice


def _map_source(
    df: DataFrame,
    spec: LinkSpec,
    source: LinkSource,
    blocks: list[Block],
    run_date: str,
    run_type: str,
    reject_null_keys: bool,
) -> DataFrame:
    for rule in [source.arrangement, *[b.unit for b in blocks]]:
        _require_stable_key_types(df, spec, rule)

    rows = valid_rows(df, source)
    if reject_null_keys:
        rows = rows.filter(~source.arrangement.has_null())

    conditions: list[Column | None] = []
    for block in blocks:
        tests = [F.expr(block.where)] if block.where else []
        if reject_null_keys:
            tests.append(~block.unit.has_null())
        conditions.append(reduce(lambda a, b: a & b, tests) if tests else None)
    if all(c is not None for c in conditions):
        rows = rows.filter(_any_of(conditions))

    if run_type in spec.opening_run_types and source.effective_from:
        effective = as_lenient_date(df, source.effective_from)
    else:
        effective = parse_run_date(run_date)

    needed = sorted({c for b in blocks for c in b.unit.columns})
    keyed = rows.select(
        surrogate_key(source.arrangement.prefix, source.arrangement.value()).alias("AR_ID"),
        effective.alias("EFF_DT"),
        *([] if len(blocks) == 1 else [_block_numbers(conditions).alias("block_numbers")]),
        *[F.col(c).alias(f"unit_{c}") for c in needed],
    )
    number = F.col("block_number")
    if len(blocks) > 1:
        keyed = keyed.select(
            "AR_ID", "EFF_DT", *[f"unit_{c}" for c in needed],
            F.explode("block_numbers").alias("block_number"),
        )
        if any(c is not None for c in conditions):
            keyed = keyed.filter(number.isNotNull())

    prefixed = [
        F.concat(
            F.lit(b.unit.prefix),
            F.coalesce(
                composite_value([f"unit_{c}" for c in b.unit.columns], b.unit.joiner, b.unit.suffix),
                F.lit(""),
            ),
        )
        for b in blocks
    ]
    return keyed.select(
        "AR_ID",
        spec.system_key(source).alias("SRC_STM_ID"),
        F.sha2(_by_block(number, prefixed), 256).alias("AU_ID"),
        _by_block(number, [spec.relationship_key(b) for b in blocks]).alias("AR_X_AU_RLTNP_TP_ID"),
        parse_run_date(run_date).alias("PPN_DT"),
        "EFF_DT",
        F.to_date(F.lit(spec.end_date)).alias("END_DT"),
    )


def _block_numbers(conditions: list[Column | None]) -> Column:
    return F.array(
        *[
            F.lit(i) if condition is None else F.when(condition, F.lit(i))
            for i, condition in enumerate(conditions)
        ]
    )


def map_links(
    tables: Callable[[str], DataFrame],
    spec: LinkSpec,
    run_date: str,
    run_type: str = "FULL",
    blocks: str | Iterable[str] = ALL_BLOCKS,
    null_keys: str = "collapse",
    one_scan: bool = True,
) -> DataFrame:
    """Relationship rows of the selected blocks, duplicates kept.

    ``tables`` gives the DataFrame for a table name and is asked only for sources
    a selected block needs. With ``null_keys="collapse"`` a null key component
    leaves the hash of the bare prefix; with ``"reject"`` such links are left out
    and :func:`null_key_rows` lists them. ``one_scan=False`` plans one branch, and
    one scan, per block.
    """
    chosen = select_blocks(spec, blocks)
    kind = run_type.strip().upper()
    if kind not in spec.run_types:
        raise ValueError(f"unknown run type {run_type!r}; use one of {list(spec.run_types)}")
    if null_keys not in ("collapse", "reject"):
        raise ValueError("null_keys is 'collapse' or 'reject'")

    branches = []
    for source in spec.sources:
        wanted = [b for b in source.blocks if b.block_id in chosen]
        if not wanted:
            continue
        df = tables(source.table)
        for group in [wanted] if one_scan else [[b] for b in wanted]:
            branches.append(
                _map_source(df, spec, source, group, run_date, kind, null_keys == "reject")
            )
    return reduce(DataFrame.unionByName, branches)


def null_key_rows(
    tables: Callable[[str], DataFrame],
    spec: LinkSpec,
    blocks: str | Iterable[str] = ALL_BLOCKS,
) -> DataFrame:
    """Every link ``null_keys="reject"`` leaves out: table, block, known key parts, null columns."""
    chosen = select_blocks(spec, blocks)
    branches = []
    for source in spec.sources:
        wanted = [b for b in source.blocks if b.block_id in chosen]
        if not wanted:
            continue
        rows = valid_rows(tables(source.table), source)
        entries = []
        for block in wanted:
            columns = list(dict.fromkeys(source.arrangement.columns + block.unit.columns))
            nulls = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
            hit = source.arrangement.has_null() | block.unit.has_null()
            if block.where:
                hit = hit & F.expr(block.where)
            entry = F.struct(
                F.lit(source.table).alias("TABLE_NAME"),
                F.lit(block.block_id).alias("BLOCK_ID"),
                F.concat_ws(
                    source.arrangement.joiner, *[F.col(c).cast("string") for c in columns]
                ).alias("KEY_PARTS"),
                F.concat_ws(",", *nulls).alias("NULL_COLUMNS"),
            )
            entries.append(F.when(hit, entry))
        branches.append(
            rows.select(F.inline(F.array(*entries))).filter(F.col("TABLE_NAME").isNotNull())
        )
    return reduce(DataFrame.unionByName, branches)


def _yields(source: LinkSource, block: Block, reject_null_keys: bool) -> Column:
    """Whether a valid row of the source gives a link of the block."""
    met = F.expr(block.where) if block.where else F.lit(True)
    if reject_null_keys:
        met = met & ~source.arrangement.has_null() & ~block.unit.has_null()
    return met


def expected_link_counts(
    tables: Callable[[str], DataFrame],
    spec: LinkSpec,
    blocks: str | Iterable[str] = ALL_BLOCKS,
    null_keys: str = "collapse",
) -> DataFrame:
    """Rows each block must yield, counted on the sources in one aggregate per table.

    ``null_keys`` is that of :func:`map_links`: with ``"reject"`` links with a null key
    component are not expected.
    """
    if null_keys not in ("collapse", "reject"):
        raise ValueError("null_keys is 'collapse' or 'reject'")
    chosen = select_blocks(spec, blocks)
    branches = []
    for source in spec.sources:
        wanted = [b for b in source.blocks if b.block_id in chosen]
        if not wanted:
            continue
        counts = valid_rows(tables(source.table), source).agg(
            *[
                F.count_if(_yields(source, b, null_keys == "reject")).alias(f"n_{b.block_id}")
                for b in wanted
            ]
        )
        entries = [
            F.struct(
                F.lit(b.block_id).alias("BLOCK_ID"),
                spec.system_key(source).alias("SRC_STM_ID"),
                spec.relationship_key(b).alias("AR_X_AU_RLTNP_TP_ID"),
                F.col(f"n_{b.block_id}").alias("EXPECTED_ROWS"),
            )
            for b in wanted
        ]
        branches.append(counts.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, branches)
