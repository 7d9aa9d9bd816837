"""Kept audit state, history of rows, and rules between tables, and their SQL twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalogue.oracles import ORACLES
from ledgerloom.catalogue.queries import ORDER_LINKS, map_all_blocks, map_blocks_subset, query
from ledgerloom.catalogue.standins import ORDER_AUDIT, table
from ledgerloom.operators import references
from ledgerloom.plans import audit_state, history
from ledgerloom.sources import sinks
from ledgerloom.sources.zones import RAW, RECONCILE, SOR, STAGING, Zones, shared_scratch

DAYS = ("20240129", "20240130", "20240131")
RULES = (
    references.Reference("line to order", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    references.Reference("line to part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
    references.Reference(
        "order to customer", "orders", ("o_custkey",), "customer", ("c_custkey",), allow_null=False
    ),
    references.Reference("text to order", "texts", ("order_text",), "orders", ("o_orderkey",)),
)


def _audited_twice(spark: SparkSession, sf_dir: str, links: DataFrame) -> DataFrame:
    """Half of the recent links first, then their partitions whole: the audit after it."""
    zones = Zones(shared_scratch(spark, "audit-state"))
    path, state = zones.table(SOR, "links"), zones.table(RECONCILE, "links_state")
    dated = links.withColumn("LINK_YEAR", F.year("EFF_DT"))
    recent = F.col("LINK_YEAR") >= 1996
    half = F.xxhash64("AR_ID", "AU_ID") % 2 == 0
    orders = table(spark, sf_dir, "orders")
    sinks.write_table(dated.filter(~recent | half), path, partition_by=["LINK_YEAR"], rebalance=True)
    audit_state.refresh_audit_state(spark, path, state, ORDER_AUDIT, "sha256")
    sinks.write_table(
        dated.filter(recent), path, partition_by=["LINK_YEAR"], replace_partitions=True, rebalance=True
    )
    return audit_state.audit_from_state(
        spark, path, state, orders, ORDER_AUDIT, "sha256", stamped=False
    )


@query
def audit_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a table some partitions of which were written again."""
    return _audited_twice(spark, sf_dir, map_all_blocks(spark, sf_dir))


@query
def audit_from_state_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of one type nulled and all rows doubled."""
    links = map_blocks_subset(spark, sf_dir)
    sub_head = ORDER_LINKS.relationship_key(ORDER_LINKS.sources[0].blocks[0])
    unit = F.when(F.col("AR_X_AU_RLTNP_TP_ID") != sub_head, F.col("AU_ID"))
    broken = links.withColumn("AU_ID", unit)
    return _audited_twice(spark, sf_dir, broken.unionByName(broken))


def _deliveries(orders: DataFrame) -> list[DataFrame]:
    """Three days of orders: overlapping, with repeated rows, changed rows and nulls."""
    rows = orders.select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        "o_orderpriority",
    )
    changed = F.when(F.col("o_orderkey") % 12 == 0, "").otherwise(F.col("o_orderpriority"))
    second = rows.filter("o_orderkey % 3 = 0").withColumn("o_orderpriority", changed)
    return [rows.filter("o_orderkey % 2 = 0"), second.unionByName(second), rows.unionByName(second)]


@query
def dedup_against_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row under the first day it came; the second day is run twice."""
    zones = Zones(shared_scratch(spark, "history"))
    seen, index = zones.table(STAGING, "orders"), zones.table(STAGING, "orders_prints")
    deliveries = dict(zip(DAYS, _deliveries(table(spark, sf_dir, "orders"))))
    for day in (DAYS[0], DAYS[1], DAYS[1], DAYS[2]):
        path = zones.table(RAW, f"orders_{day}")
        sinks.write_table(deliveries[day], path)
        history.dedup_against_history(spark, spark.read.parquet(path), day, seen, index)
    return spark.read.schema(f"{_COLUMNS}, {history.DAY} string").parquet(seen)


_COLUMNS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"


def _related(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables with faults: orders gone and doubled, customers gone and unknown, odd texts."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customer = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey"))
    present = orders.filter("o_orderkey % 10 <> 0").withColumn("o_custkey", customer)
    text = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("no "), F.col("o_orderkey").cast("string")))
    return {
        "lineitem": lines,
        "orders": present.unionByName(present.filter("o_orderkey % 9 = 0")),
        "part": table(spark, sf_dir, "part"),
        "customer": table(spark, sf_dir, "customer").filter("c_custkey % 13 <> 0"),
        "texts": orders.select(
            F.coalesce(text, F.col("o_orderkey").cast("string")).alias("order_text")
        ),
    }


@query
def referential_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rules over derived faults: orphans, nulls, repeated parents, keys of another type."""
    return references.referential_report(_related(spark, sf_dir), RULES)


@query
def referential_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines and orders that break their rules."""
    tables = _related(spark, sf_dir)
    found = []
    for rule, key in ((RULES[0], "l_orderkey"), (RULES[2], "o_orderkey")):
        rows = references.orphan_rows(tables[rule.child], tables[rule.parent], rule)
        found.append(rows.select(F.lit(rule.name).alias("rule_name"), F.col(key).alias("row_key")))
    return reduce(lambda a, b: a.unionAll(b), found)


ORACLES["audit_from_state"] = ORACLES["audit_summary"]
ORACLES["audit_from_state_faulty"] = ORACLES["audit_faulty_table"]

_ROWS = """SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS o_custkey,
    o_orderstatus, o_orderpriority FROM orders"""
_SECOND = f"""SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 12 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority
    FROM ({_ROWS}) WHERE o_orderkey % 3 = 0"""
ORACLES["dedup_against_history"] = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, min(d) AS "{history.DAY}" FROM (
        SELECT *, '{DAYS[0]}' AS d FROM ({_ROWS}) WHERE o_orderkey % 2 = 0
        UNION ALL SELECT *, '{DAYS[1]}' FROM ({_SECOND})
        UNION ALL SELECT *, '{DAYS[2]}' FROM ({_ROWS}))
    GROUP BY ALL"""

_PRESENT = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey
    FROM orders WHERE o_orderkey % 10 <> 0"""
_DOUBLED = f"SELECT * FROM ({_PRESENT}) UNION ALL SELECT * FROM ({_PRESENT}) WHERE o_orderkey % 9 = 0"
_ORDER_TEXTS = """SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'no ' || o_orderkey
    ELSE CAST(o_orderkey AS VARCHAR) END AS k FROM orders"""
_CUSTOMERS = "SELECT c_custkey AS k FROM customer WHERE c_custkey % 13 <> 0"


def _rule_sql(name: str, child: str, parent: str, allow_null: bool = True) -> str:
    """A rule between two relations of one column ``k``."""
    orphan = f"k IS NOT NULL AND k NOT IN (SELECT k FROM ({parent}) WHERE k IS NOT NULL)"
    repeated = f"SELECT k FROM ({parent}) WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1"
    return f"""SELECT '{name}' AS rule_name, CASE WHEN orphan_rows = 0 AND repeated_parents = 0
            AND ({allow_null} OR null_rows = 0) THEN 'PASS' ELSE 'FAIL' END AS status, *
        FROM (SELECT count(*) AS child_rows, count(*) FILTER (WHERE k IS NULL) AS null_rows,
            count(*) FILTER (WHERE {orphan}) AS orphan_rows,
            count(DISTINCT k) FILTER (WHERE {orphan}) AS orphan_keys,
            (SELECT count(*) FROM ({repeated})) AS repeated_parents,
            (SELECT count(DISTINCT k) FROM ({parent}) WHERE k NOT IN
                (SELECT k FROM ({child}) WHERE k IS NOT NULL)) AS unused_parents
        FROM ({child}))"""


_ORDERS = f"SELECT o_orderkey AS k FROM ({_DOUBLED})"
ORACLES["referential_rules"] = " UNION ALL ".join(
    [
        _rule_sql("line to order", "SELECT l_orderkey AS k FROM lineitem", _ORDERS),
        _rule_sql("line to part", "SELECT l_partkey AS k FROM lineitem", "SELECT p_partkey AS k FROM part"),
        _rule_sql("order to customer", f"SELECT o_custkey AS k FROM ({_DOUBLED})", _CUSTOMERS, False),
        # A text that is no number is one unknown key, so they are counted together.
        f"""SELECT * REPLACE (orphan_keys - (SELECT count(DISTINCT k) - 1 FROM ({_ORDER_TEXTS})
            WHERE k LIKE 'no %') AS orphan_keys) FROM ({_rule_sql(
            "text to order", _ORDER_TEXTS, f"SELECT CAST(k AS VARCHAR) AS k FROM ({_ORDERS})")})""",
    ]
)
ORACLES["referential_orphans"] = f"""
    SELECT 'line to order' AS rule_name, l_orderkey AS row_key FROM lineitem
    WHERE l_orderkey NOT IN (SELECT k FROM ({_ORDERS}))
    UNION ALL SELECT 'order to customer', o_orderkey FROM ({_DOUBLED})
    WHERE o_custkey IS NULL OR o_custkey NOT IN ({_CUSTOMERS})"""
