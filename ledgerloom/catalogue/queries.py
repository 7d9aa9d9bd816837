"""One query per operator, each ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.catalogue.standins import (
    CREDIT_ORDERS,
    ORDER_AUDIT,
    ORDER_LINKS,
    RUN_DATE,
    TABLES,
    accounts,
    bills,
    orders_with_gaps,
    raw_tables,
    table,
    untidy_orders,
)
from ledgerloom.functions import surrogate_key, table_checksum, with_row_hash
from ledgerloom.functions.checksums import hash_sum_lanes, portable_fingerprint, signed_sum
from ledgerloom.operators import checks, compare, mapping, merge, staging
from ledgerloom.plans import jobs
from ledgerloom.plans.links import ACCOUNT_TABLE, BILL_TABLE, LINK_TABLE, with_key_prefixes
from ledgerloom.sources import files, jdbc, sinks
from ledgerloom.sources.zones import QUARANTINE, RAW, RECONCILE, SOR, STAGING, Zones, shared_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)

RANGE_CUTS = (1_000, 5_000, 10_000)
EVEN_SLICES = 7

STAGING_RULES = (
    staging.ColumnRule("order_key", "bigint", source="order_id", required=True),
    staging.ColumnRule("order_day", "date"),
    staging.ColumnRule("amount", "decimal(18,2)"),
    staging.ColumnRule("order_status"),
)

ORDER_CONTRACT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.LongType(), False),
        T.StructField("o_orderstatus", T.StringType(), False),
        T.StructField("o_totalprice", T.DecimalType(18, 2), True),
        T.StructField("o_orderpriority", T.StringType(), True),
    ]
)

LINE_CONSTRAINTS = (
    checks.Constraint("quantity positive", "l_quantity > 0"),
    checks.Constraint("discount at most five percent", "l_discount <= 0.05"),
    checks.Constraint("known return flag", "l_returnflag IN ('A', 'N', 'R')"),
    checks.Constraint("open lines not returned", "l_linestatus <> 'O' OR l_returnflag <> 'R'"),
    checks.Constraint("tax known and positive", "nullif(l_tax, 0.0D) > 0"),
    checks.Constraint("tax positive where known", "nullif(l_tax, 0.0D) > 0", allow_null=True),
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _scratch_zones(spark: SparkSession, purpose: str) -> Zones:
    return Zones(shared_scratch(spark, purpose))


# --- relationship mapping ----------------------------------------------------


@query
def map_all_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_links(raw_tables(spark, sf_dir), ORDER_LINKS, RUN_DATE)


@query
def map_scan_per_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_links(raw_tables(spark, sf_dir), ORDER_LINKS, RUN_DATE, one_scan=False)


@query
def map_blocks_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_links(raw_tables(spark, sf_dir), ORDER_LINKS, RUN_DATE, blocks="1,3")


@query
def map_delta_effectivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_links(
        raw_tables(spark, sf_dir), ORDER_LINKS, RUN_DATE, "DELTA", blocks=["2", "7"]
    )


def _banked(spark: SparkSession, sf_dir: str, with_bank: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if with_bank:
        bank = F.when(F.col("o_orderstatus") == "F", "01").when(
            F.col("o_orderpriority") == "1-URGENT", "02"
        )
        orders = orders.withColumn("BANK_ID", bank)
    return mapping.map_links(lambda name: orders, ORDER_LINKS, RUN_DATE, blocks="7")


@query
def map_optional_filter_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _banked(spark, sf_dir, True)


@query
def map_optional_filter_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _banked(spark, sf_dir, False)


@query
def null_component_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_gaps(spark, sf_dir)
    return mapping.map_links(
        lambda name: orders, ORDER_LINKS, RUN_DATE, blocks=["1", "2", "3", "7"]
    )


@query
def null_component_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_gaps(spark, sf_dir)
    return mapping.map_links(
        lambda name: orders, ORDER_LINKS, RUN_DATE, blocks=["1", "2"], null_keys="reject"
    )


@query
def null_component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_gaps(spark, sf_dir)
    return mapping.null_key_rows(lambda name: orders, ORDER_LINKS, blocks=["1", "2"])


@query
def expected_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.expected_link_counts(raw_tables(spark, sf_dir), ORDER_LINKS)


@query
def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table lacks block 3, so that one type must fail."""
    tables = raw_tables(spark, sf_dir)
    links = mapping.map_links(tables, ORDER_LINKS, RUN_DATE, blocks="1,2,7,8")
    return compare.link_count_check(mapping.expected_link_counts(tables, ORDER_LINKS), links)


# --- keys, hashes, checksums --------------------------------------------------


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", surrogate_key("CU|", F.col("c_custkey")).alias("customer_id")
    )


@query
def row_hash_sha2(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(*PART_COLUMNS)
    return with_row_hash(part, PART_COLUMNS)


@query
def row_hash_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS)
    return with_row_hash(customer, CUSTOMER_COLUMNS, algorithm="md5")


@query
def row_hash_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blanked segment and an absent one must hash apart."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", segment.alias("c_mktsegment")
    )
    return with_row_hash(customer, ["c_name", "c_mktsegment"], "row_id", strict=True)


@query
def checksum_portable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_checksum(table(spark, sf_dir, "lineitem"), LINE_COLUMNS, "sha256")


@query
def checksum_xxhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_checksum(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)


@query
def checksum_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_checksum(table(spark, sf_dir, "lineitem").filter("l_quantity < 0"), LINE_COLUMNS)


@query
def checksum_xxhash_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per group, the lane sums of the 64-bit hash against one wide decimal sum of it."""
    hashed = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.xxhash64(*LINE_COLUMNS).alias("fingerprint")
    )
    half, full = (F.lit(str(1 << n)).cast("decimal(38,0)") for n in (63, 64))
    wide = F.sum(F.col("fingerprint").cast("decimal(19,0)")).cast("decimal(38,0)")
    sums = hashed.groupBy("l_returnflag").agg(
        F.count("*").alias("row_count"), wide.alias("wide"), *hash_sum_lanes("fingerprint")
    )
    folded = (F.pmod(F.col("wide") + half, full) - half).cast("decimal(38,0)")
    return sums.select("l_returnflag", "row_count", (signed_sum() == folded).alias("agrees"))


@query
def ingest_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingestion time per write, on every row."""
    zones = _scratch_zones(spark, "stamps")
    jobs.ingest_tables(
        spark, [files.TableSource("orders", f"{sf_dir}/orders.parquet")], zones, RUN_DATE
    )
    stamp = "INGESTION_TIMESTAMP"
    return spark.read.parquet(zones.table(RAW, "orders")).agg(
        F.count("*").alias("row_count"), F.count(stamp).alias("stamped"),
        F.countDistinct(stamp).alias("stamps"),
    )


@query
def audit_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time per audit, on every check."""
    orders, links = table(spark, sf_dir, "orders"), map_blocks_subset(spark, sf_dir)
    return checks.audit_links(links, orders, ORDER_AUDIT).agg(
        F.count("*").alias("checks"), F.count("CHECK_TIMESTAMP").alias("stamped"),
        F.countDistinct("CHECK_TIMESTAMP").alias("stamps"),
    )


@query
def map_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening dates as text, some of which are no dates."""
    day = F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("soon")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", day)
    return mapping.map_links(lambda name: orders, ORDER_LINKS, RUN_DATE, blocks="2")


@query
def row_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *LINE_COLUMNS, portable_fingerprint(LINE_COLUMNS).alias("fingerprint")
    )


# --- filters, distinct, keys --------------------------------------------------


@query
def validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.valid_rows(table(spark, sf_dir, "lineitem"), ORDER_LINKS.sources[1])


@query
def in_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.expr(CREDIT_ORDERS))


@query
def full_row_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return staging.drop_duplicate_rows(lines.unionByName(lines))


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query
def null_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_key_count(orders_with_gaps(spark, sf_dir), ["o_orderkey", "o_custkey"])


@query
def column_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.column_bounds(table(spark, sf_dir, "orders"), "o_orderkey")


# --- audit -------------------------------------------------------------------


def _audit(spark: SparkSession, sf_dir: str, target: DataFrame, **options) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return checks.audit_links(target, orders, ORDER_AUDIT, stamped=False, **options)


@query
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, map_all_blocks(spark, sf_dir), checksum_method="sha256")


@query
def audit_prescreened(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = map_all_blocks(spark, sf_dir)
    return _audit(spark, sf_dir, links, checksum_method="sha256", prescreen=True)


@query
def audit_summary_xxhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, map_all_blocks(spark, sf_dir))


@query
def audit_faulty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of one type nulled and all rows doubled."""
    links = map_blocks_subset(spark, sf_dir)
    sub_head = ORDER_LINKS.relationship_key(ORDER_LINKS.sources[0].blocks[0])
    broken = links.withColumn(
        "AU_ID", F.when(F.col("AR_X_AU_RLTNP_TP_ID") != sub_head, F.col("AU_ID"))
    )
    return _audit(spark, sf_dir, broken.unionByName(broken), checksum_method="sha256")


@query
def audit_faulty_prescreened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source gaps collapse keys, so that whole groups of links share one key pair."""
    orders = orders_with_gaps(spark, sf_dir)
    blocks = ["1", "2", "3", "7"]
    links = mapping.map_links(lambda name: orders, ORDER_LINKS, RUN_DATE, blocks=blocks)
    return checks.audit_links(
        links, orders, ORDER_AUDIT, checksum_method="sha256", stamped=False, prescreen=True
    )


@query
def audit_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, map_blocks_subset(spark, sf_dir).drop("AU_ID", "END_DT"))


@query
def audit_empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = map_blocks_subset(spark, sf_dir).filter(F.col("EFF_DT") < F.lit("1900-01-01"))
    return _audit(spark, sf_dir, links)


@query
def audit_thorough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with null key parts: as many rows as expected, but collapsed keys."""
    orders = orders_with_gaps(spark, sf_dir)
    blocks = ["1", "2", "3", "7"]
    links = mapping.map_links(lambda name: orders, ORDER_LINKS, RUN_DATE, blocks=blocks)
    expected = mapping.expected_link_counts(lambda name: orders, ORDER_LINKS, blocks)
    return checks.audit_links(
        links,
        orders,
        with_key_prefixes(ORDER_AUDIT, ORDER_LINKS),
        checksum_method="sha256",
        expected_rows=expected.agg(F.sum("EXPECTED_ROWS")),
        expected_checksum="rows:0|hash_sum:0",
        stamped=False,
    )


@query
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No customer column, statuses nulled, prices as text with gaps, one column too many."""
    orders = table(spark, sf_dir, "orders")
    drifted = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("free"))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("o_totalprice"),
        "o_orderpriority",
        F.lit("new").alias("o_note"),
    )
    return checks.schema_report(drifted, ORDER_CONTRACT)


@query
def row_count_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        checks.count_snapshot(table(spark, sf_dir, name), "2024-01-31").withColumn(
            "table_name", F.lit(name)
        )
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def constraint_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.constraint_report(table(spark, sf_dir, "lineitem"), LINE_CONSTRAINTS)


@query
def null_rate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return checks.null_rates(customer, customer.columns)


# --- source-to-target comparison ---------------------------------------------


@query
def count_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    doubled = lines.unionByName(lines)
    return compare.count_comparison(doubled, staging.drop_duplicate_rows(doubled))


@query
def count_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.count_by(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query
def sum_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.sum_by(table(spark, sf_dir, "orders"), ["o_orderstatus"], ["o_totalprice"])


@query
def totals_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = orders.filter("NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(
            F.col("o_totalprice")
        ),
    )
    return compare.compare_totals(orders, target, ["o_orderstatus"], ["o_totalprice"])


@query
def totals_fine_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drift in the fourth decimal of one group."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(20,6)")
    )
    drift = F.when(F.col("o_orderstatus") == "P", F.lit("0.0003")).otherwise(F.lit("0"))
    target = orders.withColumn(
        "o_totalprice", (F.col("o_totalprice") + drift.cast("decimal(20,6)")).cast("decimal(20,6)")
    )
    return compare.compare_totals(orders, target, ["o_orderstatus"], ["o_totalprice"])


def _drifted_orders(orders: DataFrame) -> DataFrame:
    """Changed, missing and unexpected rows at once."""
    kept = orders.filter("NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')").withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.lit("Q")).otherwise(F.col("o_orderstatus")),
    )
    added = orders.filter("o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'").withColumn(
        "o_orderkey", -F.col("o_orderkey") - 1
    )
    return kept.unionByName(added)


@query
def key_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return compare.key_diff(orders, _drifted_orders(orders), ["o_orderkey"])


@query
def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return compare.row_diff(orders, _drifted_orders(orders), ["o_orderkey"])


@query
def row_diff_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    target = lines.filter("l_returnflag <> 'R' OR l_linenumber > 3")
    return compare.row_diff(lines, target, ["l_orderkey"], keep_matched=True)


# --- staging and merging -----------------------------------------------------


@query
def enrich_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ETL_DATE that is already there is replaced."""
    lines = table(spark, sf_dir, "lineitem")
    older = staging.with_etl_date(lines, "20230101")
    return staging.with_ingest_metadata(older, RUN_DATE).drop("INGESTION_TIMESTAMP")


@query
def normalise_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.normalise(untidy_orders(spark, sf_dir), STAGING_RULES)


@query
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.quarantine_split(untidy_orders(spark, sf_dir), STAGING_RULES)[0]


@query
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.quarantine_split(untidy_orders(spark, sf_dir), STAGING_RULES)[1]


@query
def quarantine_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    good, bad = staging.split_by_rule(events, "event_type <> 'error' AND value > 0")
    return good.withColumn("zone", F.lit("stg")).unionByName(
        bad.withColumn("zone", F.lit("quarantine"))
    )


@query
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    return merge.latest_per_key(lines, ["l_orderkey"], ["l_shipdate"])


def _order_updates(orders: DataFrame) -> DataFrame:
    """Two versions of every P and O order; the later one, priority 9-NEW, must win."""
    changed = orders.filter("o_orderstatus <> 'F'")
    return changed.withColumn("o_orderpriority", F.lit("9-NEW")).unionByName(
        changed.withColumn("o_orderpriority", F.lit("0-OLD"))
    )


@query
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    base = orders.filter("o_orderstatus <> 'P'")
    return merge.merge_rows(base, _order_updates(orders), ["o_orderkey"], ["o_orderpriority"])


@query
def upsert_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged swap on a written table; the second upsert changes nothing."""
    orders = table(spark, sf_dir, "orders")
    path = shared_scratch(spark, "upsert")
    sinks.write_table(orders.filter("o_orderstatus <> 'P'"), path)
    for _ in range(2):
        sinks.upsert_table(
            spark, path, _order_updates(orders), ["o_orderkey"], ["o_orderpriority"]
        )
    return spark.read.parquet(path)


@query
def upsert_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path, keys = shared_scratch(spark, "upsert-partitions"), ["o_orderkey", "o_orderstatus"]
    sinks.write_table(orders, path, partition_by=["o_orderstatus"], rebalance=True)
    updates = orders.filter("o_orderstatus = 'P'").withColumn("o_orderpriority", F.lit("9-NEW"))
    sinks.upsert_partitions(spark, path, updates, keys, ["o_orderstatus"])
    return spark.read.parquet(path)


@query
def incremental_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return merge.rows_after(events, "ts", "2024-01-20 12:00:00")


@query
def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.high_water_mark(table(spark, sf_dir, "events"), "event_id")


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load up to a date, then two increments from the table's own watermark."""
    events, zones = table(spark, sf_dir, "events"), _scratch_zones(spark, "increments")
    for known in _known_events(events):
        jobs.ingest_increment(spark, known, zones, "events", ["event_id"], "ts")
    return spark.read.parquet(zones.table(STAGING, "events"))


def _known_events(events: DataFrame) -> list[DataFrame]:
    """What a source held at three times; at the last one everything."""
    first = [
        events.filter(F.col("ts") < F.lit(upto).cast("timestamp_ntz"))
        for upto in ("2024-01-10", "2024-01-20")
    ]
    return [*first, events]


@query
def incremental_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same increments into a table in partitions, which it keeps."""
    events, zones = table(spark, sf_dir, "events"), _scratch_zones(spark, "increments")
    for known in _known_events(events):
        jobs.ingest_increment(
            spark, known, zones, "events", ["event_id", "event_type"], "ts",
            partition_by=["event_type"],
        )
    path = zones.table(STAGING, "events")
    if sinks.partition_columns(spark, path) != ["event_type"]:
        raise ValueError(f"{path} lost its partitions")
    return spark.read.parquet(path)


@query
def incremental_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive late with the watermark's own stamp, or with none."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    events = table(spark, sf_dir, "events").withColumn(
        "ts", F.when(F.col("event_id") % 10 != 0, day)
    )
    last = F.lit("2024-01-15").cast("timestamp_ntz")
    early = F.col("event_id") % 4 < 2
    first = events.filter((F.col("ts") < last) | (early & ((F.col("ts") == last) | F.col("ts").isNull())))
    zones = _scratch_zones(spark, "late")
    for known in (first, events, events):
        jobs.ingest_increment(spark, known, zones, "events", ["event_id"], "ts")
    return spark.read.parquet(zones.table(STAGING, "events"))


# --- sources and sinks ---------------------------------------------------------


@query
def slices_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice_counts(spark, sf_dir, jdbc.value_slices("o_orderkey", RANGE_CUTS))


@query
def slices_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice_counts(spark, sf_dir, jdbc.even_slices("o_orderkey", EVEN_SLICES))


def _slice_counts(spark: SparkSession, sf_dir: str, predicates: list[str]) -> DataFrame:
    """Rows each parallel source read would fetch, in one pass."""
    counts = table(spark, sf_dir, "orders").agg(
        *[F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(predicates)]
    )
    entries = [
        F.struct(F.lit(i).alias("slice"), F.col(f"n{i}").alias("row_count"))
        for i in range(len(predicates))
    ]
    return counts.select(F.inline(F.array(*entries)))


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_scratch(spark, "roundtrip")
    sinks.write_table(table(spark, sf_dir, "orders"), path)
    return files.read_parquet(spark, path)


@query
def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite, append, then an ignored write: every order twice."""
    orders = table(spark, sf_dir, "orders")
    path = shared_scratch(spark, "modes")
    for mode in ("overwrite", "append", "ignore"):
        sinks.write_table(orders, path, mode)
    return spark.read.parquet(path)


@query
def partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition replaced, the others kept."""
    orders = table(spark, sf_dir, "orders")
    path, by = shared_scratch(spark, "partitions"), ["o_orderpriority"]
    sinks.write_table(orders, path, partition_by=by, rebalance=True)
    low = orders.filter("o_orderpriority = '5-LOW'").withColumn("o_orderstatus", F.lit("X"))
    sinks.write_table(low, path, partition_by=by, replace_partitions=True)
    return spark.read.parquet(path)


@query
def json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _scratch_zones(spark, "snapshots")
    sinks.write_table(table(spark, sf_dir, "orders"), zones.table(SOR, "orders"))
    for day in ("2024-01-30", "2024-01-31"):
        jobs.snapshot_counts(spark, zones, "orders", day)
    path = zones.table(RECONCILE, "date")
    return files.read_json(spark, path, "row_count BIGINT, run_date STRING")


def _landed_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as CSV, with keys that are no numbers in one segment."""
    customer = table(spark, sf_dir, "customer")
    key = F.when(
        F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), F.col("c_custkey").cast("string"))
    ).otherwise(F.col("c_custkey").cast("string"))
    zones = _scratch_zones(spark, "landing")
    path = zones.table("source", "customer")
    landed = customer.withColumn("c_custkey", key)
    landed.write.option("header", "true").csv(path)
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )
    return jobs.land_csv(spark, path, schema, zones, "customer", RUN_DATE)


@query
def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _landed_customers(spark, sf_dir)[0]
    return good.drop("ETL_DATE", "INGESTION_TIMESTAMP")


@query
def csv_landing_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_customers(spark, sf_dir)[1].select(files.CORRUPT_COLUMN, "c_name")


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with and without a column in one table, read with merged schemas."""
    orders = table(spark, sf_dir, "orders")
    path = shared_scratch(spark, "evolution")
    sinks.write_table(orders.filter("o_orderstatus = 'F'").drop("o_orderpriority"), path)
    sinks.write_table(orders.filter("o_orderstatus <> 'F'"), path, "append")
    return files.read_parquet(spark, path, merge_schema=True)


@query
def stacked_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    older = orders.filter("o_orderstatus = 'F'").drop("o_orderpriority")
    newer = orders.filter("o_orderstatus <> 'F'").drop("o_custkey")
    return staging.stack_versions([older, newer])


# --- jobs --------------------------------------------------------------------


@query
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables, one of which does not exist: the others still arrive."""
    zones = _scratch_zones(spark, "ingest")
    sources = [
        files.TableSource("orders", f"{sf_dir}/orders.parquet"),
        files.TableSource("absent", f"{sf_dir}/absent.parquet"),
        files.TableSource("customer", f"{sf_dir}/customer.parquet"),
    ]
    results = jobs.ingest_tables(
        spark, sources, zones, RUN_DATE, workers=2, raise_on_failure=False
    )
    jobs.append_run_log(jobs.run_log(spark, results, "run-1", "ingest", RAW), zones)
    log = spark.read.parquet(zones.table(RECONCILE, "etl_pipeline_audit"))
    return log.select("pipeline_name", "stage_name", "table_name", "status", "row_count")


@query
def ingest_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two run dates side by side, the second run twice: one copy per date."""
    zones = _scratch_zones(spark, "ingest-dates")
    source = files.TableSource("orders", f"{sf_dir}/orders.parquet")
    for run_date in ("20240130", RUN_DATE, RUN_DATE):
        jobs.ingest_tables(spark, [source], zones, run_date, by_date=True)
    raw = spark.read.parquet(zones.table(RAW, "orders")).drop("INGESTION_TIMESTAMP")
    return raw.withColumn("ETL_DATE", F.col("ETL_DATE").cast("string"))


def _banking_zones(
    spark: SparkSession, sf_dir: str, purpose: str, orders: DataFrame | None = None
) -> Zones:
    """Account and bill tables ingested into a raw zone."""
    zones = _scratch_zones(spark, purpose)
    sources = []
    held = accounts(table(spark, sf_dir, "orders") if orders is None else orders)
    for name, rows in ((ACCOUNT_TABLE, held), (BILL_TABLE, bills(spark, sf_dir))):
        location = zones.table("source", name)
        sinks.write_table(rows, location)
        sources.append(files.TableSource(name, location))
    jobs.ingest_tables(spark, sources, zones, RUN_DATE)
    return zones


@query
def zone_chain_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, then the relationship table in the banking layout."""
    zones = _banking_zones(spark, sf_dir, "chain")
    jobs.build_links(spark, zones, RUN_DATE)
    return spark.read.parquet(zones.table(SOR, LINK_TABLE))


@query
def zone_chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _banking_zones(spark, sf_dir, "chain-audit")
    jobs.build_links(spark, zones, RUN_DATE)
    report = jobs.audit_link_table(spark, zones, thorough=True, checksum_method="sha256")
    return report.select("CHECK_NAME", "STATUS", "DETAILS")


@query
def zone_chain_audit_rejecting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with null key parts left out, and none of them expected."""
    gaps = orders_with_gaps(spark, sf_dir)
    zones = _banking_zones(spark, sf_dir, "chain-reject", gaps)
    jobs.build_links(spark, zones, RUN_DATE, null_keys="reject")
    report = jobs.audit_link_table(
        spark, zones, thorough=True, null_keys="reject", checksum_method="sha256",
        expected_checksum="rows:0|hash_sum:0",
    )
    return report.select("CHECK_NAME", "STATUS", "DETAILS")


@query
def mapping_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping file with block ids of its own, in upper case."""
    path = shared_scratch(spark, "mapping")
    sources = [
        replace(s, blocks=tuple(replace(b, block_id=f"B{b.block_id}") for b in s.blocks))
        for s in ORDER_LINKS.sources
    ]
    text = replace(ORDER_LINKS, sources=tuple(sources)).to_json()
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    spec = mapping.LinkSpec.from_json(files.read_whole_text(spark, path))
    return mapping.map_links(raw_tables(spark, sf_dir), spec, RUN_DATE, blocks="B1, B3")


@query
def zone_chain_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw with every row doubled, deduplicated into staging, copied to the system of record."""
    zones = _scratch_zones(spark, "copy")
    lines = table(spark, sf_dir, "lineitem")
    sinks.write_table(lines.unionByName(lines), zones.table(RAW, "lineitem"))
    jobs.stage_table(spark, zones, "lineitem")
    jobs.publish_table(spark, zones, "lineitem")
    return spark.read.parquet(zones.table(SOR, "lineitem"))


@query
def zone_chain_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy raw rows staged by rules and upserted into the system of record."""
    zones = _scratch_zones(spark, "clean")
    sinks.write_table(untidy_orders(spark, sf_dir), zones.table(RAW, "orders"))
    jobs.stage_table(spark, zones, "orders", STAGING_RULES)
    jobs.publish_table(spark, zones, "orders", keys=["order_key"])
    return spark.read.parquet(zones.table(SOR, "orders"))


@query
def zone_chain_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows staging set aside."""
    zones = _scratch_zones(spark, "quarantine")
    sinks.write_table(untidy_orders(spark, sf_dir), zones.table(RAW, "orders"))
    jobs.stage_table(spark, zones, "orders", STAGING_RULES)
    return spark.read.parquet(zones.table(QUARANTINE, "orders")).drop(jobs.QUARANTINE_RUN)


@query
def quarantine_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two run dates, the second run twice: both stay, each once."""
    zones = _scratch_zones(spark, "quarantine-runs")
    untidy = untidy_orders(spark, sf_dir)
    for run_date, rows in (("20240130", untidy.filter("order_status <> 'F  '")), (RUN_DATE, untidy)):
        source = zones.table("source", f"orders-{run_date}")
        sinks.write_table(rows, source)
        given = [files.TableSource("orders", source)]
        jobs.ingest_tables(spark, given, zones, run_date, by_date=True)
    for run_date in ("20240130", RUN_DATE, RUN_DATE):
        jobs.stage_table(spark, zones, "orders", STAGING_RULES, run_date=run_date)
    held = spark.read.parquet(zones.table(QUARANTINE, "orders"))
    run = F.col(jobs.QUARANTINE_RUN).cast("string").alias(jobs.QUARANTINE_RUN)
    return held.select("order_id", "order_day", "amount", "order_status", "REJECT_REASON", run)


@query
def zone_chain_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging against a system of record that drifted away from it."""
    zones = _scratch_zones(spark, "diff")
    orders = table(spark, sf_dir, "orders")
    sinks.write_table(orders, zones.table(STAGING, "orders"))
    sinks.write_table(_drifted_orders(orders), zones.table(SOR, "orders"))
    jobs.reconcile_table(spark, zones, "orders", ["o_orderkey"], ORDER_COLUMNS[1:])
    return spark.read.parquet(zones.table(RECONCILE, "orders_diff"))


@query
def zone_chain_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bill table of an earlier run, stamped with this run's date."""
    zones = _scratch_zones(spark, "bills")
    older = staging.with_ingest_metadata(bills(spark, sf_dir), "20230101")
    sinks.write_table(older, zones.table(RAW, BILL_TABLE))
    jobs.stamp_bills(spark, zones, RUN_DATE)
    stamped = spark.read.parquet(zones.table(SOR, "JOB_B_OUTPUT"))
    return stamped.drop("INGESTION_TIMESTAMP")
