"""Upserts by business key, incremental extraction, and change logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Watermark = int | Decimal | date | datetime | str | None


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row with the largest ``order_by`` values per key.

    Remaining ties are decided by the other columns from left to right, so the
    result does not depend on partitioning. Nulls lose. Taking the maximum of a
    struct combines on the map side: a key with very many versions sends one row
    per task. Columns must be orderable (no maps).
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    compared = [*order_by, *rest]
    if not compared:
        return df.select(*keys).distinct()
    newest = F.max(F.struct(*compared)).alias("newest")
    return (
        df.groupBy(*keys)
        .agg(newest)
        .select(*[F.col(c) if c in keys else F.col(f"newest.{c}") for c in df.columns])
    )


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"update_{k}"]) for k in keys])


def merge_rows(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``base`` with every key of ``updates`` replaced or inserted.

    Null keys match null keys, so merging twice equals merging once. ``updates`` is
    evaluated twice; :func:`ledgerloom.sources.sinks.upsert_table` writes it down
    first, which a source that may change between two reads needs.
    """
    fresh = latest_per_key(in_base_order(base, updates), keys, order_by)
    return replace_keys(base, fresh, keys)


def in_base_order(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates with the base's columns first and new ones after; none may be missing."""
    missing = [c for c in base.columns if c not in updates.columns]
    if missing:
        raise ValueError(f"updates lack the columns {missing}")
    return updates.select(*base.columns, *[c for c in updates.columns if c not in base.columns])


def replace_keys(
    base: DataFrame, fresh: DataFrame, keys: Sequence[str], broadcast: bool | None = None
) -> DataFrame:
    """Merge rows that are already unique per key.

    Only the keys take part in the join. ``broadcast=True`` is for a caller who has
    measured them and spares the base its shuffle; ``False`` asks for a sort-merge
    join, whose skewed base partitions adaptive execution splits; by default Spark
    decides from its own size check. Columns new in the fresh rows are null in the
    base's.
    """
    changed = fresh.select(*[F.col(k).alias(f"update_{k}") for k in keys])
    if broadcast is not None:
        changed = changed.hint("broadcast" if broadcast else "merge")
    kept = base.join(changed, _same_key(base, changed, keys), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def newest_of_both(
    base: DataFrame, fresh: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """``fresh`` with each row that the base has newer, or later in its order, replaced by that."""
    wanted = fresh.select(*[F.col(k).alias(f"update_{k}") for k in keys])
    known = base.join(wanted, _same_key(base, wanted, keys), "left_semi")
    both = fresh.unionByName(known, allowMissingColumns=True)
    return latest_per_key(both, keys, order_by)


def rows_after(
    df: DataFrame,
    column: str,
    watermark: Watermark,
    inclusive: bool = False,
    nulls: bool = False,
) -> DataFrame:
    """Rows past the watermark; the plain comparison is pushed down to Parquet and JDBC.

    Without a watermark all rows are taken. ``inclusive`` takes rows at the watermark
    again, among which some may have come late; ``nulls`` takes rows without a value,
    which no watermark ever passes. A merge by key bears both. Dates and times may be
    given as text, read in the column's own type.
    """
    if watermark is None:
        return df
    if isinstance(watermark, (date, datetime)):
        watermark = str(watermark)
    mark = F.lit(watermark).cast(df.schema[column].dataType)
    wanted = F.col(column) >= mark if inclusive else F.col(column) > mark
    return df.filter(wanted | F.col(column).isNull() if nulls else wanted)


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest value of the column as text, fit for :func:`rows_after`."""
    return df.agg(F.max(column).cast("string").alias("high_water_mark"))


def unplaced_rows(df: DataFrame, column: str) -> DataFrame:
    """How many rows a plain watermark cannot see because the column is null."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("unplaced_rows"))


# --- change logs -------------------------------------------------------------

# Marks of a change log (fixed values, overridable per log).
INSERTED, UPDATED, DELETED_MARK = "I", "U", "D"
# The column by which a state table tells tombstones from live rows.
IS_DELETED = "IS_DELETED"
REFUSED_BECAUSE = "REFUSED_BECAUSE"


@dataclass(frozen=True)
class ChangeLog:
    """How a change log is laid out.

    Each change carries the whole row as it became; of a deletion only the key counts.
    ``sequence`` orders the changes of one key, whatever order they arrive in.
    """

    keys: tuple[str, ...]
    sequence: str
    operation: str = "OP"
    inserts: tuple[str, ...] = (INSERTED,)
    updates: tuple[str, ...] = (UPDATED,)
    deletes: tuple[str, ...] = (DELETED_MARK,)

    @property
    def order(self) -> list[str]:
        return [self.sequence, IS_DELETED]

    def payload(self, df: DataFrame) -> list[str]:
        fixed = {*self.keys, self.sequence, self.operation, IS_DELETED}
        return [c for c in df.columns if c not in fixed]


def snapshot_state(rows: DataFrame, log: ChangeLog, sequence: int | str | datetime) -> DataFrame:
    """A full load as a state: every row live, as of the sequence number it was taken at.

    Rows of one key collapse to the one whose columns compare largest.
    """
    if log.sequence in rows.columns:
        raise ValueError(f"the snapshot has a column {log.sequence} of its own")
    live = rows.withColumns({log.sequence: F.lit(sequence), IS_DELETED: F.lit(False)})
    payload = log.payload(live)
    return latest_per_key(live.select(*log.keys, *log.order, *payload), log.keys, log.order)


def refused_changes(changes: DataFrame, log: ChangeLog, horizon: Watermark = None) -> DataFrame:
    """Changes that cannot be applied, with REFUSED_BECAUSE.

    Those with an unknown mark, without a sequence number, or older than the horizon:
    tombstones older than that are gone, so nothing tells such a change from one that a
    deletion had overtaken.
    """
    return changes.withColumn(REFUSED_BECAUSE, _refusal(changes, log, horizon)).filter(
        F.col(REFUSED_BECAUSE).isNotNull()
    )


def _refusal(changes: DataFrame, log: ChangeLog, horizon: Watermark) -> Column:
    known = F.col(log.operation).isin(*log.inserts, *log.updates, *log.deletes)
    reason = F.when(F.col(log.sequence).isNull(), "no sequence number").when(
        ~F.coalesce(known, F.lit(False)), "unknown operation"
    )
    if horizon is None:
        return reason
    return reason.when(_older(changes, log, horizon), "older than the horizon")


def _older(df: DataFrame, log: ChangeLog, horizon: Watermark) -> Column:
    kind = df.schema[log.sequence].dataType
    mark = str(horizon) if isinstance(horizon, (date, datetime)) else horizon
    return F.col(log.sequence) < F.lit(mark).cast(kind)


def change_states(changes: DataFrame, log: ChangeLog, horizon: Watermark = None) -> DataFrame:
    """The newest applicable change of each key as a state row; a deletion is a tombstone.

    Of changes with one key and sequence number, which a sound log repeats but does not
    contradict, a deletion stands, else the one whose columns compare largest.
    """
    deleted = F.col(log.operation).isin(*log.deletes)
    usable = changes.filter(_refusal(changes, log, horizon).isNull())
    rows = usable.select(
        *log.keys,
        log.sequence,
        deleted.alias(IS_DELETED),
        *[F.when(~deleted, F.col(c)).alias(c) for c in log.payload(changes)],
    )
    return latest_per_key(rows, log.keys, log.order)


def apply_changes(
    state: DataFrame, changes: DataFrame, log: ChangeLog, horizon: Watermark = None
) -> DataFrame:
    """The state after a change log: per key the newest of what it held and what arrived.

    Inserts, updates and deletions are taken by sequence number, not by mark: an update of
    an unknown key inserts, a late change loses to a newer one, a repeated one changes
    nothing. A deletion leaves a tombstone, so a change that it overtook stays without
    effect whenever it arrives. Any split of a log into batches, in any order, ends in
    the same rows. Tombstones older than ``horizon`` are dropped, and changes older than
    it are refused (:func:`refused_changes`); until it passes them, changes may be late.

    Null keys match null keys. The state is unique per key, so one aggregate, combined on
    the map side, does the work of two joins; a key with very many changes sends one row
    per task. Columns new in the changes are null in older rows.
    """
    fresh = change_states(changes, log, horizon)
    both = state.unionByName(fresh, allowMissingColumns=True)
    return without_old_tombstones(latest_per_key(both, log.keys, log.order), log, horizon)


def merge_states(
    state: DataFrame, fresh: DataFrame, log: ChangeLog, few: bool = False
) -> DataFrame:
    """Two states of unique keys as one.

    ``few`` says that ``fresh`` is small enough to be sent to every task: then the state
    is not shuffled. Rows that stand are found by one join; what they stand against, by
    another that reads keys and order alone.
    """
    if not few:
        both = state.unionByName(fresh, allowMissingColumns=True)
        return latest_per_key(both, log.keys, log.order)
    compared = [*log.order, *log.payload(state)]
    arrived = fresh.select(
        *[F.col(k).alias(f"update_{k}") for k in log.keys],
        F.struct(*compared).alias("update_order"),
    )
    own = F.struct(*[state[c] for c in compared])
    same = _same_key(state, arrived, log.keys)
    overtaken = same & (F.col("update_order") >= own)
    standing = state.join(F.broadcast(arrived), overtaken, "left_anti")
    newer = state.join(
        F.broadcast(arrived), same & (F.col("update_order") < own), "left_semi"
    ).select(*[F.col(k).alias(f"update_{k}") for k in log.keys])
    applied = fresh.join(newer, _same_key(fresh, newer, log.keys), "left_anti")
    return standing.unionByName(applied, allowMissingColumns=True)


def without_old_tombstones(state: DataFrame, log: ChangeLog, horizon: Watermark) -> DataFrame:
    if horizon is None:
        return state
    return state.filter(~(F.col(IS_DELETED) & _older(state, log, horizon)))


def current_rows(state: DataFrame, log: ChangeLog) -> DataFrame:
    """The live rows of a state, as the source's table has them."""
    return state.filter(~F.col(IS_DELETED)).drop(IS_DELETED, log.sequence)


def snapshot_changes(
    before: DataFrame, after: DataFrame, log: ChangeLog, sequence: int | str | datetime
) -> DataFrame:
    """The change log between two full loads of a source that keeps none.

    Insertions and updates carry the new row, deletions the old one; rows that stayed as
    they were give nothing. Both loads are tagged, put together and aggregated by key, so
    neither is joined. Rows that share a key count as the one that compares largest.
    """
    columns = [c for c in after.columns if c not in log.keys]
    row = F.struct(*[F.col(c) for c in columns])
    sides = before.select(*log.keys, row.alias("old"), F.lit(None).alias("new")).unionByName(
        after.select(*log.keys, F.lit(None).alias("old"), row.alias("new"))
    )
    per_key = sides.groupBy(*log.keys).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    mark = (
        F.when(F.col("old").isNull(), log.inserts[0])
        .when(F.col("new").isNull(), log.deletes[0])
        .when(~F.col("old").eqNullSafe(F.col("new")), log.updates[0])
    )
    changed = per_key.withColumn(log.operation, mark).filter(F.col(log.operation).isNotNull())
    return changed.select(
        *log.keys,
        F.lit(sequence).alias(log.sequence),
        log.operation,
        F.coalesce("new", "old").alias("row"),
    ).select(*log.keys, log.sequence, log.operation, "row.*")
