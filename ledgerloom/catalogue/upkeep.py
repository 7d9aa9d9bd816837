"""Release, archive and resumed runs over the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalogue.oracles import _STAGED, ORACLES
from ledgerloom.catalogue.queries import STAGING_RULES, query
from ledgerloom.catalogue.standins import RUN_DATE, table, untidy_orders
from ledgerloom.operators import staging
from ledgerloom.plans import jobs, upkeep
from ledgerloom.sources import sinks
from ledgerloom.sources.files import TableSource
from ledgerloom.sources.zones import QUARANTINE, RAW, STAGING, Zones, shared_scratch

# A day that reads "soon" is none; an amount must be there now.
LATER_RULES = (
    STAGING_RULES[0],
    staging.ColumnRule("order_day", "date", null_tokens=(*staging.NULL_TOKENS, "SOON")),
    staging.ColumnRule("amount", "decimal(18,2)", required=True),
    STAGING_RULES[3],
)
DAYS = ("20240128", "20240129", "20240130")


@query
def quarantine_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging and quarantine after held rows were judged by new rules, twice."""
    zones = Zones(shared_scratch(spark, "release"))
    sinks.write_table(untidy_orders(spark, sf_dir), zones.table(RAW, "orders"))
    jobs.stage_table(spark, zones, "orders", STAGING_RULES)
    for _ in range(2):
        upkeep.release_quarantine(spark, zones, "orders", LATER_RULES)
    staged = spark.read.parquet(zones.table(STAGING, "orders"))
    held = spark.read.parquet(zones.table(QUARANTINE, "orders"))
    return staged.select("*", F.lit("").alias("reason")).unionByName(
        staging.normalise(held, LATER_RULES).select(
            *staged.columns, F.col(staging.REJECT_REASON).alias("reason")
        )
    )


def _days(spark: SparkSession, sf_dir: str) -> Zones:
    """Orders landed in raw, a third on each day."""
    zones = Zones(shared_scratch(spark, "archive"))
    orders = table(spark, sf_dir, "orders")
    for number, day in enumerate(DAYS):
        part = orders.filter(F.col("o_orderkey") % 3 == number)
        landed = part.withColumn(upkeep.RAW_DAY, F.lit(day))
        sinks.write_table(
            landed, zones.table(RAW, "orders"),
            partition_by=[upkeep.RAW_DAY], replace_partitions=True,
        )
    return zones


@query
def archive_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archived days against their manifest, and the day that stays in raw."""
    zones = _days(spark, sf_dir)
    for _ in range(2):
        upkeep.archive_days(spark, zones, "orders", DAYS[2])
    moved = upkeep.archive_report(spark, zones, "orders").withColumn("zone", F.lit(upkeep.ARCHIVE))
    left = spark.read.parquet(zones.table(RAW, "orders")).groupBy(
        F.col(upkeep.RAW_DAY).cast("string").alias(upkeep.RAW_DAY)
    )
    return moved.unionByName(
        left.agg(F.count("*").alias("row_count")).select(
            "*", F.lit(True).alias("verified"), F.lit(RAW).alias("zone")
        )
    )


@query
def ingest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stopped at a missing table, mended and started again: rows in raw, tries logged."""
    zones = Zones(shared_scratch(spark, "resumed"))
    run = upkeep.Run(RUN_DATE, "daily")
    late = zones.table("source", "lines")
    given = [
        TableSource("orders", f"{sf_dir}/orders.parquet"),
        TableSource("lines", late),
        TableSource("parts", f"{sf_dir}/part.parquet"),
    ]
    upkeep.ingest_resumed(spark, given, zones, RUN_DATE, run, raise_on_failure=False)
    sinks.write_table(table(spark, sf_dir, "lineitem"), late)
    upkeep.ingest_resumed(spark, given, zones, RUN_DATE, run)
    log = spark.read.parquet(zones.table("reconcile", upkeep.RUN_LOG))
    return log.groupBy("table_name").agg(
        F.count("*").alias("tries"), F.max("row_count").alias("row_count")
    )


@query
def incremental_kept_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early orders, then all of them with late ones changed, from the kept watermark on."""
    zones = Zones(shared_scratch(spark, "watermark"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("changed_on"), "o_orderpriority"
    )
    late = F.col("changed_on") >= F.lit("1997-01-01").cast("date")
    priority = F.when(late, F.lit("late")).otherwise(F.col("o_orderpriority"))
    for given in (
        orders.filter("changed_on < DATE '1996-01-01'"), orders.withColumn("o_orderpriority", priority)
    ):
        upkeep.ingest_increment_kept(spark, given, zones, "orders", ["o_orderkey"], "changed_on")
    return spark.read.parquet(zones.table(STAGING, "orders"))


ORACLES["quarantine_release"] = f"""
    SELECT {_STAGED}, '' AS reason FROM orders
    WHERE o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'
    UNION ALL SELECT {_STAGED}, 'amount: required' FROM orders
    WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"""
ORACLES["archive_verified"] = f"""
    SELECT CASE o_orderkey % 3 WHEN 0 THEN '{DAYS[0]}' WHEN 1 THEN '{DAYS[1]}' ELSE '{DAYS[2]}' END
        AS "ETL_DATE", count(*) AS row_count, TRUE AS verified,
        CASE WHEN o_orderkey % 3 = 2 THEN 'raw' ELSE 'archive' END AS zone
    FROM orders GROUP BY 1, 3, 4"""
ORACLES["ingest_resumed"] = """
    SELECT 'orders' AS table_name, 1::BIGINT AS tries, count(*) AS row_count FROM orders
    UNION ALL SELECT 'lines', 2, count(*) FROM lineitem
    UNION ALL SELECT 'parts', 1, count(*) FROM part"""
ORACLES["incremental_kept_watermark"] = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS changed_on,
        CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 'late' ELSE o_orderpriority END
            AS o_orderpriority FROM orders"""
