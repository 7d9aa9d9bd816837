"""Change logs over the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalogue.oracles import ORACLES
from ledgerloom.catalogue.queries import query
from ledgerloom.catalogue.standins import RUN_DATE, table
from ledgerloom.operators import merge
from ledgerloom.plans import jobs
from ledgerloom.sources import sinks
from ledgerloom.sources.zones import QUARANTINE, SOR, STAGING, Zones, shared_scratch

ORDER_LOG = merge.ChangeLog(("o_orderkey",), "SEQ")
DAY_LOG = merge.ChangeLog(("o_orderkey", "o_orderstatus"), "SEQ")

# (which orders change, sequence number, mark, the new price's factor): every order is
# inserted, then some are updated, deleted, or deleted and inserted again.
HISTORY = (
    ("TRUE", 10, "I", 1),
    ("o_orderkey % 2 = 0", 20, "U", 2),
    ("o_orderkey % 3 = 0", 30, "D", 0),
    ("o_orderkey % 6 = 0", 40, "I", 3),
    ("o_orderkey % 5 = 0", 50, "U", 4),
    ("o_orderkey % 7 = 0", 60, "D", 0),
)


def order_changes(orders: DataFrame) -> DataFrame:
    """The history of all orders as one log; prices are whole so that any engine agrees."""
    steps = F.array(
        *[
            F.when(
                F.expr(where),
                F.struct(
                    F.lit(sequence).alias("SEQ"), F.lit(mark).alias("OP"),
                    F.lit(factor).cast("bigint").alias("factor"),
                ),
            )
            for where, sequence, mark, factor in HISTORY
        ]
    )
    each = orders.select("*", F.explode(F.array_compact(steps)).alias("step")).select("*", "step.*")
    price = (F.floor("o_totalprice") * F.col("factor")).alias("price")
    return each.select("o_orderkey", "o_orderstatus", "SEQ", "OP", price, "o_orderpriority")


def batches(changes: DataFrame) -> list[DataFrame]:
    """The log in three deliveries: late ones last, one repeated, neither in order."""
    late = (F.col("SEQ") <= 30) & (F.col("o_orderkey") % 4 == 0)
    odd = F.col("SEQ") % 20 == 10
    return [changes.filter(odd & ~late), changes.filter(~odd | (F.col("SEQ") == 10)), changes.filter(late)]


def _through(
    spark: SparkSession, deliveries: list[DataFrame], log: merge.ChangeLog, horizons=(), **how
) -> Zones:
    zones = Zones(shared_scratch(spark, "changes"))
    for number, delivery in enumerate(deliveries):
        if horizons:
            how["horizon"] = horizons[number]
        path = zones.table("raw", f"delivery_{number}")
        sinks.write_table(delivery, path)
        landed = spark.read.parquet(path)
        jobs.ingest_changes(spark, landed, zones, "orders", log, RUN_DATE, **how)
    return zones


@query
def cdc_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries into a staged state, and the table made of it."""
    changes = order_changes(table(spark, sf_dir, "orders"))
    zones = _through(spark, batches(changes), ORDER_LOG)
    jobs.publish_current(spark, zones, "orders", ORDER_LOG)
    return spark.read.parquet(zones.table(SOR, "orders"))


@query
def cdc_apply_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log applied at once to the state of a full load, without writing."""
    changes = order_changes(table(spark, sf_dir, "orders"))
    first = changes.filter("SEQ = 10").drop("SEQ", "OP")
    state = merge.snapshot_state(first, ORDER_LOG, 10)
    state = merge.apply_changes(state, changes.filter("SEQ > 10"), ORDER_LOG)
    return merge.current_rows(state, ORDER_LOG)


@query
def cdc_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log into a state in partitions, latest delivery first."""
    changes = order_changes(table(spark, sf_dir, "orders"))
    zones = _through(spark, batches(changes)[::-1], DAY_LOG, partition_by=["o_orderstatus"])
    return spark.read.parquet(zones.table(STAGING, "orders"))


@query
def cdc_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tombstones below the horizon go; what arrives from below it is refused."""
    changes = order_changes(table(spark, sf_dir, "orders"))
    early, late = changes.filter("o_orderkey % 4 <> 0 OR SEQ <> 20"), changes.filter(
        "o_orderkey % 4 = 0 AND SEQ = 20"
    )
    zones = _through(spark, [early, late], ORDER_LOG, horizons=(None, 60))
    state = spark.read.parquet(zones.table(STAGING, "orders"))
    held = spark.read.parquet(zones.table(QUARANTINE, "orders_changes"))
    counted = state.groupBy(F.when(F.col("IS_DELETED"), "tombstone").otherwise("live").alias("kind"))
    refused = held.groupBy(F.col("REFUSED_BECAUSE").alias("kind"))
    return counted.agg(F.count("*").alias("row_count")).unionByName(
        refused.agg(F.count("*").alias("row_count"))
    )


@query
def cdc_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log between two full loads, for a source that keeps none."""
    before, after = _loads(table(spark, sf_dir, "orders"))
    return merge.snapshot_changes(before, after, ORDER_LOG, 7)


@query
def cdc_snapshots_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applied to the first load, that log gives the second."""
    before, after = _loads(table(spark, sf_dir, "orders"))
    changes = merge.snapshot_changes(before, after, ORDER_LOG, 7)
    state = merge.apply_changes(merge.snapshot_state(before, ORDER_LOG, 1), changes, ORDER_LOG)
    return merge.current_rows(state, ORDER_LOG)


def _loads(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    changed = F.when(F.col("o_orderkey") % 4 == 0, F.lit("changed")).otherwise(F.col("o_orderpriority"))
    after = rows.filter("o_orderkey % 3 <> 0").withColumn("o_orderpriority", changed)
    return rows.filter("o_orderkey % 5 <> 0"), after


_STEPS = " UNION ALL ".join(
    f"""SELECT o_orderkey, o_orderstatus, CAST({sequence} AS INTEGER) AS "SEQ", '{mark}' AS "OP",
    CAST(floor(o_totalprice) AS BIGINT) * {factor} AS price, o_orderpriority FROM orders WHERE {where}"""
    for where, sequence, mark, factor in HISTORY
)
_NEWEST = f"""SELECT * FROM ({_STEPS})
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY "SEQ" DESC) = 1"""

ORACLES["cdc_apply_changes"] = ORACLES["cdc_apply_once"] = f"""
    SELECT o_orderkey, o_orderstatus, price, o_orderpriority FROM ({_NEWEST}) WHERE "OP" <> 'D'"""
ORACLES["cdc_by_partition"] = f"""
    SELECT o_orderkey, o_orderstatus, "SEQ", "OP" = 'D' AS "IS_DELETED",
        CASE WHEN "OP" <> 'D' THEN price END AS price,
        CASE WHEN "OP" <> 'D' THEN o_orderpriority END AS o_orderpriority FROM ({_NEWEST})"""
ORACLES["cdc_horizon"] = f"""
    WITH newest AS (SELECT * FROM ({_STEPS}) WHERE "SEQ" <> 20 OR o_orderkey % 4 <> 0
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY "SEQ" DESC) = 1)
    SELECT CASE WHEN "OP" = 'D' THEN 'tombstone' ELSE 'live' END AS kind, count(*) AS row_count
    FROM newest WHERE "OP" <> 'D' OR "SEQ" >= 60 GROUP BY 1
    UNION ALL SELECT 'older than the horizon', count(*) FROM ({_STEPS})
        WHERE "SEQ" = 20 AND o_orderkey % 4 = 0"""
_BEFORE = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 5 <> 0"
_AFTER = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN 'changed'
    ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0"""
ORACLES["cdc_from_snapshots"] = f"""
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CAST(7 AS INTEGER) AS "SEQ",
        CASE WHEN b.o_orderkey IS NULL THEN 'I' WHEN a.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS "OP",
        CASE WHEN a.o_orderkey IS NULL THEN b.o_custkey ELSE a.o_custkey END AS o_custkey,
        CASE WHEN a.o_orderkey IS NULL THEN b.o_orderpriority ELSE a.o_orderpriority END AS o_orderpriority
    FROM ({_BEFORE}) b FULL JOIN ({_AFTER}) a USING (o_orderkey)
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderpriority <> b.o_orderpriority"""
ORACLES["cdc_snapshots_replayed"] = _AFTER

