"""Columns whose types change over time: promotion of versions, and contracts compared."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers from narrow to wide, and the digits a decimal needs for each.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_EXACT_IN_DOUBLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType(), T.DoubleType())
MOST_DIGITS = 38
MISFITS = "MISFIT_COLUMNS"


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_WHOLE[kind], 0) if kind in _WHOLE else None


def promoted_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both without loss; text if none does.

    Whole numbers widen up to long, then to decimals; decimals keep all digits on both sides
    of the point while 38 are enough. Numbers of up to 32 bits go into doubles, longs and
    decimals do not. Dates go into timestamps without a zone. A column of nulls takes any type.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if one in _WHOLE and other in _WHOLE:
        return max(one, other, key=_WHOLE.get)
    if one in _EXACT_IN_DOUBLE and other in _EXACT_IN_DOUBLE:
        return T.DoubleType()
    a, b = _as_decimal(one), _as_decimal(other)
    if a and b:
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else T.StringType()
    if {one, other} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.StringType()


def promoted_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Columns of all versions in order of appearance; nullable if any lacks or allows nulls."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            known = kinds.get(field.name, T.NullType())
            kinds[field.name] = promoted_type(known, field.dataType)
    always = {
        name for name in kinds
        if all(name in s.names and not s[name].nullable for s in schemas)
    }
    return T.StructType([T.StructField(n, k, n not in always) for n, k in kinds.items()])


def _as_type(name: str, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return F.col(name)
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(name)
    return F.col(name).try_cast(want)


def promoted_versions(
    versions: Sequence[DataFrame], ceilings: T.StructType | None = None
) -> DataFrame:
    """All rows of versions of a table whose columns and types differ, in promoted types.

    ``ceilings`` names the widest type some columns may have. A value that does not fit it
    becomes null and its column is named in :data:`MISFITS`, an array that is empty for rows
    that fit; nothing is lost without a ceiling. Narrow: no shuffle, and each version's
    scan reads only its own columns.
    """
    schema = promoted_schema([v.schema for v in versions])
    top = {f.name: f.dataType for f in ceilings} if ceilings else {}
    if unknown := sorted(set(top) - set(schema.names)):
        raise ValueError(f"ceilings of {unknown}, which no version has")
    if MISFITS in schema.names:
        raise ValueError(f"{MISFITS} is a column of the result")
    frames = []
    for version in versions:
        columns, lost = [], []
        for field in schema:
            want = top.get(field.name, field.dataType)
            if field.name not in version.columns:
                columns.append(F.lit(None).cast(want).alias(field.name))
                continue
            value = _as_type(field.name, version.schema[field.name].dataType, want)
            columns.append(value.alias(field.name))
            if field.name in top:
                unfit = ~_kept_whole(field.name, version.schema[field.name].dataType, want, value)
                lost.append(F.when(unfit, F.lit(field.name)))
        misfits = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
        rows = version.select(*columns, misfits.alias(MISFITS))
        fits = F.size(MISFITS) == 0
        names = [
            F.when(fits | ~F.array_contains(MISFITS, n), F.col(n)).alias(n) if n in top else F.col(n)
            for n in schema.names
        ]
        frames.append(rows.select(*names, MISFITS))
    return reduce(lambda a, b: a.unionAll(b), frames)


def _kept_whole(name: str, have: T.DataType, want: T.DataType, value: Column) -> Column:
    """Whether a value survives the cast: not lost, and the same when cast back."""
    if promoted_type(have, want) == want:
        return F.lit(True)
    back = value.try_cast(have) if not isinstance(have, T.StringType) else F.col(name)
    return F.col(name).isNull() | F.coalesce(back == F.col(name), F.lit(False)) & value.isNotNull()


# --- contracts ----------------------------------------------------------------


def _changes(old: T.StructType, new: T.StructType) -> list[tuple]:
    """(column, change, was, is, backward, forward): whether readers of the new contract can
    read rows of the old one, and readers of the old one rows of the new."""
    found: list[tuple] = []
    for name in dict.fromkeys([*old.names, *new.names]):
        if name not in old.names:
            field = new[name]
            kind = field.dataType.simpleString()
            found.append((name, "ADDED", None, kind, field.nullable, True))
            continue
        if name not in new.names:
            field = old[name]
            found.append((name, "REMOVED", field.dataType.simpleString(), None, True, field.nullable))
            continue
        was, now = old[name], new[name]
        if was.dataType != now.dataType:
            both = promoted_type(was.dataType, now.dataType)
            widened, narrowed = both == now.dataType, both == was.dataType
            change = "WIDENED" if widened else "NARROWED" if narrowed else "RETYPED"
            types = (was.dataType.simpleString(), now.dataType.simpleString())
            found.append((name, change, *types, widened, narrowed))
        if was.nullable != now.nullable:
            kinds = ("nullable" if was.nullable else "required", "nullable" if now.nullable else "required")
            change = "RELAXED" if now.nullable else "TIGHTENED"
            found.append((name, change, *kinds, now.nullable, was.nullable))
    return found


def contract_changes(old: T.StructType, new: T.StructType, rows: DataFrame) -> DataFrame:
    """A row per change between two versions of a contract, tried on rows kept under the old.

    ``backward``: readers of the new contract can read what the old one allowed. ``forward``:
    readers of the old one can read what the new one allows. ``rows_at_odds`` counts those of
    ``rows`` the change would refuse, so a change that breaks the contract on paper but no
    row can be told from one that does. One pass, no shuffle of rows.
    """
    measures, entries = [F.count(F.lit(1)).alias("row_count")], []
    for i, (name, change, was, now, backward, forward) in enumerate(_changes(old, new)):
        odd = F.lit(False)
        if change == "ADDED" and not backward:
            odd = F.col(name).isNull() if name in rows.columns else F.lit(True)
        elif change == "TIGHTENED":
            odd = F.col(name).isNull()
        elif change in ("NARROWED", "RETYPED"):
            have, want = rows.schema[name].dataType, new[name].dataType
            odd = ~_kept_whole(name, have, want, _as_type(name, have, want))
        measures.append(F.count_if(odd).alias(f"odd_{i}"))
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(change).alias("change"),
                F.lit(was).cast("string").alias("was"),
                F.lit(now).cast("string").alias("now"),
                F.lit(backward).alias("backward"),
                F.lit(forward).alias("forward"),
                F.col(f"odd_{i}").alias("rows_at_odds"),
            )
        )
    kind = (
        "array<struct<column_name:string,change:string,was:string,now:string,"
        "backward:boolean,forward:boolean,rows_at_odds:bigint>>"
    )
    listed = F.array(*entries).cast(kind)
    return rows.agg(*measures).select(F.inline(listed))


def compatible(old: T.StructType, new: T.StructType, direction: str = "full") -> bool:
    """Whether a new version may follow: ``backward``, ``forward`` or ``full`` (both)."""
    if direction not in ("backward", "forward", "full"):
        raise ValueError(f"unknown direction {direction!r}")
    found = _changes(old, new)
    backward, forward = all(c[4] for c in found), all(c[5] for c in found)
    return {"backward": backward, "forward": forward, "full": backward and forward}[direction]
