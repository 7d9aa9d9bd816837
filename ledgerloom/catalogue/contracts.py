"""Versions with other types, and contracts compared, over the given tables; their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.catalogue.oracles import ORACLES
from ledgerloom.catalogue.queries import query
from ledgerloom.catalogue.standins import table
from ledgerloom.operators import contracts
from ledgerloom.sources import sinks
from ledgerloom.sources.zones import RAW, Zones, shared_scratch


def _versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three years of lines in files of their own: narrow numbers, then wide, then texts."""
    lines = table(spark, sf_dir, "lineitem")
    parts = [
        lines.filter("l_linenumber <= 2").select(
            "l_orderkey", F.col("l_linenumber").cast("int").alias("line"),
            F.col("l_quantity").cast("int").alias("quantity"),
        ),
        lines.filter("l_linenumber BETWEEN 3 AND 4").select(
            F.col("l_orderkey").cast("int").alias("l_orderkey"),
            F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
            F.col("l_returnflag").alias("flag"),
        ),
        lines.filter("l_linenumber > 4").select(
            "l_orderkey",
            F.when(F.col("l_orderkey") % 5 == 0, "none")
            .otherwise(F.col("l_linenumber").cast("string")).alias("line"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_returnflag").alias("flag"),
        ),
    ]
    zones, read = Zones(shared_scratch(spark, "versions")), []
    for number, part in enumerate(parts):
        path = zones.table(RAW, f"lines_{number}")
        sinks.write_table(part, path)
        read.append(spark.read.parquet(path))
    return read


@query
def promoted_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row in types that hold all three versions."""
    rows = contracts.promoted_versions(_versions(spark, sf_dir))
    return rows.select(
        "l_orderkey", "line", F.col("quantity").cast("bigint").alias("quantity"), "flag",
        F.lit(rows.schema["quantity"].dataType.simpleString()).alias("quantity_type"),
        F.size(contracts.MISFITS).alias("misfits"),
    )


@query
def promoted_with_ceilings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers held to whole numbers; what is none is named."""
    ceilings = T.StructType([T.StructField("line", T.IntegerType())])
    rows = contracts.promoted_versions(_versions(spark, sf_dir), ceilings)
    return rows.select("l_orderkey", "line", F.array_join(contracts.MISFITS, ",").alias("misfits"))


@query
def contract_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under a second contract, tried on all orders with some keys blanked."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.col("o_orderpriority"),
    )
    old = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.LongType(), True),
            T.StructField("o_orderstatus", T.StringType(), True),
            T.StructField("o_orderpriority", T.StringType(), False),
        ]
    )
    new = T.StructType(
        [
            T.StructField("o_orderkey", T.ByteType(), False),
            T.StructField("o_custkey", T.DecimalType(20, 0), False),
            T.StructField("o_orderstatus", T.StringType(), True),
            T.StructField("o_channel", T.StringType(), False),
        ]
    )
    return contracts.contract_changes(old, new, orders)


_LINE = "CASE WHEN l_linenumber > 4 AND l_orderkey % 5 = 0"
ORACLES["promoted_versions"] = f"""
    SELECT l_orderkey, {_LINE} THEN 'none' ELSE CAST(l_linenumber AS VARCHAR) END AS line,
        CAST(l_quantity AS BIGINT) AS quantity,
        CASE WHEN l_linenumber > 2 THEN l_returnflag END AS flag,
        'decimal(21,2)' AS quantity_type, 0 AS misfits FROM lineitem"""
ORACLES["promoted_with_ceilings"] = f"""
    SELECT l_orderkey, CAST({_LINE} THEN NULL ELSE l_linenumber END AS INTEGER) AS line,
        {_LINE} THEN 'line' ELSE '' END AS misfits FROM lineitem"""
ORACLES["contract_changes"] = """
    SELECT * FROM (VALUES
        ('o_orderkey', 'NARROWED', 'bigint', 'tinyint', FALSE, TRUE,
            (SELECT count(*) FROM orders WHERE o_orderkey NOT BETWEEN -128 AND 127)),
        ('o_custkey', 'WIDENED', 'bigint', 'decimal(20,0)', TRUE, FALSE, 0),
        ('o_custkey', 'TIGHTENED', 'nullable', 'required', FALSE, TRUE,
            (SELECT count(*) FROM orders WHERE o_orderkey % 6 = 0 OR o_custkey IS NULL)),
        ('o_orderpriority', 'REMOVED', 'string', NULL, TRUE, FALSE, 0),
        ('o_channel', 'ADDED', NULL, 'string', FALSE, TRUE, (SELECT count(*) FROM orders))
    ) AS t(column_name, change, was, now, backward, forward, rows_at_odds)"""
