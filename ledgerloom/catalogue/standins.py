"""How the given tables stand in for account, bill and staging tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.checks import AuditSpec
from ledgerloom.operators.mapping import KeyRule, LinkSpec
from ledgerloom.plans.links import ACCOUNT_TABLE, ACCOUNTS, BILL_TABLE, BILLS, LINK_AUDIT, LINKS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
RUN_DATE = "20240131"

VALID_ORDERS = "o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"
VALID_LINES = "l_returnflag = 'N' AND l_linestatus = 'O'"
CREDIT_ORDERS = "o_orderpriority IN ('1-URGENT', '2-HIGH')"

_UNIT_COLUMNS = {
    ("ACID",): ("o_orderkey",),
    ("GL_SUB_HEAD_CODE", "SOL_ID", "ACCT_CRNCY_CODE"): (
        "o_orderpriority", "o_custkey", "o_orderstatus",
    ),
}
_LINE_KEY = ("l_orderkey", "l_linenumber")

ORDER_LINKS: LinkSpec = replace(
    LINKS,
    sources=(
        replace(
            ACCOUNTS,
            arrangement=replace(ACCOUNTS.arrangement, columns=("o_orderkey",)),
            valid=VALID_ORDERS,
            effective_from="o_orderdate",
            blocks=tuple(
                replace(
                    b,
                    unit=replace(b.unit, columns=_UNIT_COLUMNS[b.unit.columns]),
                    where=CREDIT_ORDERS if b.where else None,
                )
                for b in ACCOUNTS.blocks
            ),
        ),
        replace(
            BILLS,
            arrangement=KeyRule(BILLS.arrangement.prefix, _LINE_KEY, joiner="-"),
            valid=VALID_LINES,
            blocks=tuple(
                replace(b, unit=replace(b.unit, columns=_LINE_KEY, joiner="-"))
                for b in BILLS.blocks
            ),
        ),
    ),
)

ORDER_AUDIT: AuditSpec = replace(LINK_AUDIT, source_valid=VALID_ORDERS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Orders as accounts and lines as bills, in their own columns."""
    names = {ACCOUNT_TABLE: "orders", BILL_TABLE: "lineitem"}
    return lambda name: table(spark, sf_dir, names[name])


def accounts(orders: DataFrame) -> DataFrame:
    """Orders in the column layout of the account table."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("ACID"),
        F.when(F.col("o_orderstatus") != "P", "Y").otherwise("N").alias("ENTITY_CRE_FLG"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Y").otherwise("N").alias("DEL_FLG"),
        F.col("o_orderdate").alias("ACCT_OPN_DATE"),
        F.col("o_orderpriority").alias("GL_SUB_HEAD_CODE"),
        F.col("o_custkey").cast("string").alias("SOL_ID"),
        F.col("o_orderstatus").alias("ACCT_CRNCY_CODE"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CLA")
        .when(F.col("o_orderpriority") == "2-HIGH", "ODA")
        .otherwise("SBA")
        .alias("SCHM_TYPE"),
    )


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the column layout of the bill table."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in _LINE_KEY]).alias("BILL_ID"),
        F.when(F.col("l_returnflag") == "N", "N").otherwise("Y").alias("DEL_FLG"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("ENTITY_CRE_FLG"),
    )


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with key parts blanked: no order key on urgent F orders, no customer on high ones."""
    return (
        table(spark, sf_dir, "orders")
        .withColumn(
            "o_orderkey",
            F.when(
                ~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")),
                F.col("o_orderkey"),
            ),
        )
        .withColumn(
            "o_custkey", F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_custkey"))
        )
    )


def untidy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text: padded, mixed date formats, null tokens and one unreadable date."""
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("  "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("order_id"),
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format(day, "yyyyMMdd"))
        .when(priority == "3-MEDIUM", F.date_format(day, "dd/MM/yyyy"))
        .when(priority == "4-NOT SPECIFIED", F.lit(" n/a "))
        .otherwise(F.lit("soon"))
        .alias("order_day"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NULL"))
        .otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
        .alias("amount"),
        F.concat(F.col("o_orderstatus"), F.lit("  ")).alias("order_status"),
    )
