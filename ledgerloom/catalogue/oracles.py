"""The catalogue's queries in SQL, written independently of the operators.

``xxhash64`` is the only function without a portable twin; queries built on it
have no entry.
"""

from __future__ import annotations

from ledgerloom.catalogue.standins import (
    CREDIT_ORDERS,
    RUN_DATE,
    TABLES,
    VALID_LINES,
    VALID_ORDERS,
)

RUN_DAY = "DATE '2024-01-31'"


def _key(prefix: str, value: str) -> str:
    return f"sha256('{prefix}' || coalesce(CAST({value} AS VARCHAR), ''))"


def _links(relation: str, valid: str, system: str, kind: str, ar: tuple[str, str],
           au: tuple[str, str], effective: str) -> str:
    return f"""SELECT {_key(*ar)} AS "AR_ID", {_key('CL|SRC_STM', f"'{system}'")} AS "SRC_STM_ID",
        {_key(*au)} AS "AU_ID", {_key('CL|AR_X_AU_TP', f"'{kind}'")} AS "AR_X_AU_RLTNP_TP_ID",
        {RUN_DAY} AS "PPN_DT", {effective} AS "EFF_DT", DATE '9999-12-31' AS "END_DT"
        FROM {relation} WHERE {valid}"""


def _link_sql(
    blocks: str, orders: str = "orders", full: bool = True, extra: str = "TRUE"
) -> str:
    """UNION ALL of the chosen blocks over orders and lines."""
    opened = "CAST(o_orderdate AS DATE)" if full else RUN_DAY
    account = ("AR|TBAADM.GAM", "o_orderkey")
    valid = f"{VALID_ORDERS} AND {extra}"
    sub_head = "o_orderpriority || '.' || CAST(o_custkey AS VARCHAR) || '.' || o_orderstatus"
    line = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"

    def account_links(kind: str, prefix: str, unit: str, where: str = "TRUE") -> str:
        condition = f"{valid} AND {where}"
        return _links(orders, condition, "TBAADM.GAM", kind, account, (prefix, unit), opened)

    def balance(suffix: str) -> str:
        return f"CAST(o_orderkey AS VARCHAR) || '.{suffix}'"

    own = "AU|TBAADM.GAM"
    branches = {
        "1": account_links("AR_X_GLSH", "AU|TBAADM.GSH", sub_head),
        "2": account_links("AR_X_ACT_CLS_BAL", own, balance("CLS_BAL")),
        "3": account_links(
            "AR_X_ACT_USED_PRVN_AMT", own, balance("USED_PRVN_AMT"), CREDIT_ORDERS
        ),
        "7": account_links("AR_X_ACT_BAL", own, balance("BAL")),
        "8": _links("lineitem", VALID_LINES, "TBAADM.FBM", "AR_X_ACT_BAL",
                    ("AR|TBAADM.FBM", line), ("AU|TBAADM.FBM", f"{line} || '.BAL'"), RUN_DAY),
    }
    return "\nUNION ALL\n".join(branches[b] for b in blocks)


_GAPS = """(SELECT
    CASE WHEN NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') THEN o_orderkey END
        AS o_orderkey,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey END AS o_custkey,
    o_orderstatus, o_orderpriority, o_orderdate FROM orders) AS gaps"""

_ALL = "12378"


def _checksum(fingerprint: str) -> str:
    """Signed 64-bit fold of a sum of fingerprints."""
    half, full = "9223372036854775808::HUGEINT", "18446744073709551616::HUGEINT"
    folded = f"(coalesce(sum({fingerprint}), 0)::HUGEINT + {half}) % {full} - {half}"
    return f"'rows:' || count(*) || '|hash_sum:' || CAST({folded} AS VARCHAR)"


def _fingerprint(text: str) -> str:
    return f"('0x' || substr(sha256({text}), 1, 15))::BIGINT"


_LINK_FINGERPRINT = _fingerprint(
    "concat_ws('||', coalesce(AR_ID, ''), coalesce(AU_ID, ''), AR_X_AU_RLTNP_TP_ID)"
)
_LINE_FINGERPRINT = _fingerprint(
    "concat_ws('||', l_orderkey::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR, "
    "l_linenumber::VARCHAR, l_returnflag)"
)


def _verdict(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


def _audit_sql(links: str, source: str = "orders", extra: str = "") -> str:
    return f"""
WITH links AS ({links}),
source AS (SELECT count(*) AS n FROM {source} WHERE {VALID_ORDERS}),
target AS (SELECT count(*) AS n, {_checksum(_LINK_FINGERPRINT)} AS hashed,
    count(*) FILTER (WHERE AR_ID IS NULL OR AU_ID IS NULL) AS nulls FROM links),
doubles AS (SELECT count(*) AS n FROM (
    SELECT 1 FROM links GROUP BY AR_ID, AU_ID HAVING count(*) > 1))
SELECT 'Row Count' AS "CHECK_NAME", {_verdict('target.n > 0')} AS "STATUS",
    'Raw GAM Valid Rows: ' || source.n || ', SOR Rows: ' || target.n AS "DETAILS"
    FROM source, target
UNION ALL SELECT 'Duplicate Key', {_verdict('n = 0')},
    'Found ' || n || ' duplicate (AR_ID, AU_ID) pairs in SOR' FROM doubles
UNION ALL SELECT 'Null Key', {_verdict('nulls = 0')},
    'Found ' || nulls || ' records with null AR_ID or AU_ID' FROM target
UNION ALL SELECT 'Hash Checksum', 'PASS', 'SOR Checksum: ' || hashed FROM target
UNION ALL SELECT 'Schema Validation', 'PASS', 'Schema matches 100%'
{extra}"""


_BARE_ARRANGEMENTS = "sha256('AR|TBAADM.GAM'), sha256('AR|TBAADM.FBM')"
_BARE_UNITS = "sha256('AU|TBAADM.GSH'), sha256('AU|TBAADM.GAM'), sha256('AU|TBAADM.FBM')"

_THOROUGH = f"""
UNION ALL SELECT 'Collapsed Key', {_verdict('n = 0')},
    'Found ' || n || ' records keyed on a bare prefix' FROM (
    SELECT count(*) AS n FROM links
    WHERE AR_ID IN ({_BARE_ARRANGEMENTS}) OR AU_ID IN ({_BARE_UNITS}))
UNION ALL SELECT 'Expected Rows', {_verdict('target.n = expected.n')},
    'Expected Rows: ' || expected.n || ', SOR Rows: ' || target.n FROM target, (
    SELECT 3 * count(*) + count(*) FILTER (WHERE {CREDIT_ORDERS}) AS n
    FROM orders WHERE {VALID_ORDERS}) AS expected
UNION ALL SELECT 'Expected Checksum', 'FAIL',
    'Expected: rows:0|hash_sum:0, SOR: ' || hashed FROM target"""

# Every row that was to be made was made, and none on a bare prefix.
_AS_EXPECTED = """
UNION ALL SELECT 'Collapsed Key', 'PASS', 'Found 0 records keyed on a bare prefix'
UNION ALL SELECT 'Expected Rows', 'PASS',
    'Expected Rows: ' || n || ', SOR Rows: ' || n FROM target"""

_REJECTING = "\nUNION ALL\n".join(
    [
        _link_sql("1", orders=_GAPS, extra="o_orderkey IS NOT NULL AND o_custkey IS NOT NULL"),
        _link_sql("237", orders=_GAPS, extra="o_orderkey IS NOT NULL"),
        _link_sql("8"),
    ]
)

_BROKEN = f"""SELECT AR_ID, CASE WHEN AR_X_AU_RLTNP_TP_ID <> {_key('CL|AR_X_AU_TP', "'AR_X_GLSH'")}
    THEN AU_ID END AS AU_ID, AR_X_AU_RLTNP_TP_ID FROM ({_link_sql('13')})"""

_SKIPPED = "Skipped, missing columns: [''AU_ID'', ''END_DT'']"


def _expected_counts(blocks: str = _ALL) -> str:
    kinds = {
        "1": ("GAM", "AR_X_GLSH", "TRUE"),
        "2": ("GAM", "AR_X_ACT_CLS_BAL", "TRUE"),
        "3": ("GAM", "AR_X_ACT_USED_PRVN_AMT", CREDIT_ORDERS),
        "7": ("GAM", "AR_X_ACT_BAL", "TRUE"),
        "8": ("FBM", "AR_X_ACT_BAL", "TRUE"),
    }
    parts = []
    for block in blocks:
        system, kind, where = kinds[block]
        relation, valid = (
            ("orders", VALID_ORDERS) if system == "GAM" else ("lineitem", VALID_LINES)
        )
        source = f"'TBAADM.{system}'"
        parts.append(
            f"""SELECT '{block}' AS "BLOCK_ID", {_key('CL|SRC_STM', source)} AS "SRC_STM_ID",
            {_key('CL|AR_X_AU_TP', f"'{kind}'")} AS "AR_X_AU_RLTNP_TP_ID",
            count(*) AS "EXPECTED_ROWS" FROM {relation} WHERE {valid} AND {where}"""
        )
    return "\nUNION ALL\n".join(parts)


_LINES = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag"
_ALL_LINES = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)

_DRIFTED = """(
    SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderstatus = 'P' THEN 'Q' ELSE o_orderstatus END AS o_orderstatus,
        o_orderpriority
    FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_orderpriority
    FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')"""

_STAGED = """
    o_orderkey AS order_key,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        THEN CAST(o_orderdate AS DATE) END AS order_day,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
    o_orderstatus AS order_status"""

_CONSTRAINTS = {
    "quantity positive": "l_quantity > 0",
    "discount at most five percent": "l_discount <= 0.05",
    "known return flag": "l_returnflag IN ('A', 'N', 'R')",
    "open lines not returned": "NOT (l_linestatus = 'O' AND l_returnflag = 'R')",
    "tax known and positive": "l_tax > 0",
    "tax positive where known": "l_tax >= 0",
}

ORACLES: dict[str, str] = {
    "map_all_blocks": _link_sql(_ALL),
    "map_scan_per_block": _link_sql(_ALL),
    "map_blocks_subset": _link_sql("13"),
    "map_delta_effectivity": _link_sql("27", full=False),
    "map_optional_filter_present": _link_sql("7", extra="o_orderstatus = 'F'"),
    "map_optional_filter_absent": _link_sql("7"),
    "null_component_key": _link_sql("1237", orders=_GAPS),
    "null_component_rejected": _link_sql("1", orders=_GAPS,
                                         extra="o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
    + "\nUNION ALL\n"
    + _link_sql("2", orders=_GAPS, extra="o_orderkey IS NOT NULL"),
    "null_component_rows": f"""
        SELECT 'TBAADM_GAM_TDY' AS "TABLE_NAME", '1' AS "BLOCK_ID",
            concat_ws('.', o_orderkey::VARCHAR, o_orderpriority, o_custkey::VARCHAR,
                o_orderstatus) AS "KEY_PARTS",
            CASE WHEN o_orderkey IS NULL THEN 'o_orderkey' ELSE 'o_custkey' END AS "NULL_COLUMNS"
        FROM {_GAPS} WHERE {VALID_ORDERS} AND (o_orderkey IS NULL OR o_custkey IS NULL)
        UNION ALL
        SELECT 'TBAADM_GAM_TDY', '2', '', 'o_orderkey'
        FROM {_GAPS} WHERE {VALID_ORDERS} AND o_orderkey IS NULL""",
    "expected_links": _expected_counts(),
    "link_counts": f"""
        WITH wanted AS ({_expected_counts()}), found AS ({_link_sql("1278")}),
        counted AS (SELECT SRC_STM_ID, AR_X_AU_RLTNP_TP_ID, count(*) AS n FROM found GROUP BY 1, 2)
        SELECT SRC_STM_ID AS "SRC_STM_ID", AR_X_AU_RLTNP_TP_ID AS "AR_X_AU_RLTNP_TP_ID",
            EXPECTED_ROWS AS "EXPECTED_ROWS", coalesce(n, 0) AS "ACTUAL_ROWS",
            {_verdict('EXPECTED_ROWS = coalesce(n, 0)')} AS "STATUS"
        FROM wanted LEFT JOIN counted USING (SRC_STM_ID, AR_X_AU_RLTNP_TP_ID)""",
    "surrogate_keys": f"""SELECT c_custkey, {_key('CU|', 'c_custkey')} AS customer_id FROM customer""",
    "row_hash_sha2": """SELECT p_partkey, p_name, p_brand, p_type, p_size,
        sha256(concat_ws('||', p_partkey::VARCHAR, p_name, p_brand, p_type, p_size::VARCHAR))
        AS "HASH_VALUE" FROM part""",
    "row_hash_md5": """SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
        md5(concat_ws('||', c_custkey::VARCHAR, c_name, c_nationkey::VARCHAR, c_mktsegment))
        AS "HASH_VALUE" FROM customer""",
    "row_hash_strict": """
        SELECT c_custkey, c_name, c_mktsegment, sha256(length(c_name) || ':' || c_name ||
            coalesce(length(c_mktsegment) || ':' || c_mktsegment, '-')) AS row_id
        FROM (SELECT c_custkey, c_name, CASE c_mktsegment WHEN 'BUILDING' THEN ''
            WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)""",
    "checksum_portable": f"""SELECT {_checksum(_LINE_FINGERPRINT)} AS "CHECKSUM" FROM lineitem""",
    "checksum_empty": """SELECT 'empty_dataframe' AS "CHECKSUM" """,
    "row_fingerprints": f"SELECT {_LINES}, {_LINE_FINGERPRINT} AS fingerprint FROM lineitem",
    "validity_filter": f"SELECT * FROM lineitem WHERE {VALID_LINES}",
    "in_list_filter": f"SELECT * FROM orders WHERE {CREDIT_ORDERS}",
    "full_row_dedup": "SELECT DISTINCT * FROM lineitem",
    "duplicate_keys": """SELECT l_orderkey, l_partkey, count(*) AS row_count FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "null_key_count": f"""SELECT count(*) AS null_rows FROM {_GAPS}
        WHERE o_orderkey IS NULL OR o_custkey IS NULL""",
    "column_bounds": "SELECT min(o_orderkey) AS min_value, max(o_orderkey) AS max_value FROM orders",
    "audit_summary": _audit_sql(_link_sql(_ALL)),
    "audit_faulty_table": _audit_sql(f"{_BROKEN} UNION ALL {_BROKEN}"),
    "audit_prescreened": _audit_sql(_link_sql(_ALL)),
    "audit_faulty_prescreened": _audit_sql(_link_sql("1237", orders=_GAPS), _GAPS),
    "audit_missing_column": f"""
        SELECT 'Row Count' AS "CHECK_NAME", 'PASS' AS "STATUS",
            'Raw GAM Valid Rows: ' || s.n || ', SOR Rows: ' || t.n AS "DETAILS"
        FROM (SELECT count(*) AS n FROM orders WHERE {VALID_ORDERS}) s,
            (SELECT count(*) AS n FROM ({_link_sql("13")})) t
        UNION ALL SELECT name, 'SKIP', '{_SKIPPED}' FROM
            (VALUES ('Duplicate Key'), ('Null Key'), ('Hash Checksum')) AS v(name)
        UNION ALL SELECT 'Schema Validation', 'FAIL', 'Missing Columns: [''AU_ID'', ''END_DT'']'""",
    "audit_empty_table": f"""
        SELECT 'Row Count' AS "CHECK_NAME", 'FAIL' AS "STATUS",
            'Raw GAM Valid Rows: ' || count(*) || ', SOR Rows: 0' AS "DETAILS"
        FROM orders WHERE {VALID_ORDERS}
        UNION ALL SELECT * FROM (VALUES
            ('Duplicate Key', 'PASS', 'Found 0 duplicate (AR_ID, AU_ID) pairs in SOR'),
            ('Null Key', 'PASS', 'Found 0 records with null AR_ID or AU_ID'),
            ('Hash Checksum', 'PASS', 'SOR Checksum: empty_dataframe'),
            ('Schema Validation', 'PASS', 'Schema matches 100%'))""",
    "audit_thorough": _audit_sql(_link_sql("1237", orders=_GAPS), _GAPS, _THOROUGH),
    "schema_check": """
        SELECT 'o_orderkey' AS column_name, 'OK' AS status, 'bigint' AS expected_type,
            'bigint' AS actual_type, CAST(0 AS BIGINT) AS offending_rows
        UNION ALL SELECT 'o_custkey', 'MISSING', 'bigint', '', 0
        UNION ALL SELECT 'o_orderstatus', 'OK', 'string', 'string',
            count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
        UNION ALL SELECT 'o_totalprice', 'TYPE_MISMATCH', 'decimal(18,2)', 'string',
            count(*) FILTER (WHERE o_orderpriority = '5-LOW') FROM orders
        UNION ALL SELECT 'o_orderpriority', 'OK', 'string', 'string', 0
        UNION ALL SELECT 'o_note', 'EXTRA', '', 'string', 0""",
    "row_count_snapshot": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, '2024-01-31' AS run_date FROM {t}"
        for t in TABLES
    ),
    "constraint_suite": "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS constraint_name, {_verdict(f'count(*) FILTER (WHERE NOT ({rule})) = 0')}
            AS status, count(*) FILTER (WHERE NOT ({rule})) AS violations,
            count(*) AS row_count FROM lineitem"""
        for name, rule in _CONSTRAINTS.items()
    ),
    "null_rate_profile": "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS column_name, count(*) FILTER (WHERE {rule}) AS null_count,
            count(*) AS row_count, (count(*) FILTER (WHERE {rule}))::DOUBLE / count(*)::DOUBLE
            AS null_rate FROM customer"""
        for name, rule in {
            "c_custkey": "FALSE",
            "c_mktsegment": "c_mktsegment = 'BUILDING'",
            "c_acctbal": "c_acctbal < 0",
        }.items()
    ),
    "count_before_after": """SELECT 2 * b.n AS rows_before, a.n AS rows_after,
        a.n - 2 * b.n AS difference FROM (SELECT count(*) AS n FROM lineitem) b,
        (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM lineitem)) a""",
    "count_by_status": """SELECT o_orderstatus, o_orderpriority, count(*) AS row_count
        FROM orders GROUP BY 1, 2""",
    "sum_by_status": """SELECT o_orderstatus, count(*) AS row_count,
        sum(CAST(o_totalprice AS DECIMAL(18,2))) AS sum_o_totalprice FROM orders GROUP BY 1""",
    "totals_compared": """
        WITH s AS (SELECT o_orderstatus, count(*) AS n,
                sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1),
        t AS (SELECT o_orderstatus, count(*) AS n, sum(CAST(o_totalprice +
                CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS DECIMAL(18,2))) AS v
            FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') GROUP BY 1)
        SELECT o_orderstatus, s.n AS source_rows, t.n AS target_rows, s.v AS source_o_totalprice,
            t.v AS target_o_totalprice,
            CASE WHEN s.n = t.n AND s.v = t.v THEN 'PASS' ELSE 'FAIL' END AS status
        FROM s JOIN t USING (o_orderstatus)""",
    "key_diff": f"""
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
            CASE WHEN t.o_orderkey IS NULL THEN 'MISSING' ELSE 'UNEXPECTED' END AS status
        FROM orders s FULL OUTER JOIN {_DRIFTED} t ON s.o_orderkey = t.o_orderkey
        WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL""",
    "row_diff": f"""
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
            CASE WHEN s.o_orderkey IS NULL THEN 0::BIGINT ELSE 1 END AS source_rows,
            CASE WHEN t.o_orderkey IS NULL THEN 0::BIGINT ELSE 1 END AS target_rows,
            CASE WHEN t.o_orderkey IS NULL THEN 'MISSING'
                WHEN s.o_orderkey IS NULL THEN 'UNEXPECTED' ELSE 'CHANGED' END AS status
        FROM orders s FULL OUTER JOIN {_DRIFTED} t ON s.o_orderkey = t.o_orderkey
        WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_custkey <> t.o_custkey
            OR s.o_orderstatus <> t.o_orderstatus OR s.o_orderpriority <> t.o_orderpriority""",
    "row_diff_repeated_keys": f"""
        WITH s AS (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL),
        t AS (SELECT *, count(*) AS n FROM lineitem
            WHERE l_returnflag <> 'R' OR l_linenumber > 3 GROUP BY ALL),
        b AS (SELECT l_orderkey, coalesce(s.n, 0) AS sn, coalesce(t.n, 0) AS tn
            FROM s FULL OUTER JOIN t USING ({_ALL_LINES}))
        SELECT l_orderkey, CAST(sum(sn) AS BIGINT) AS source_rows,
            CAST(sum(tn) AS BIGINT) AS target_rows,
            CASE WHEN sum(tn) = 0 THEN 'MISSING' WHEN bool_or(sn <> tn) THEN 'CHANGED'
                ELSE 'MATCHED' END AS status FROM b GROUP BY 1""",
    "enrich_metadata": f"""SELECT *, '{RUN_DATE}' AS "ETL_DATE" FROM lineitem""",
    "normalise_staging": f"SELECT {_STAGED} FROM (SELECT * REPLACE (CASE WHEN o_orderpriority "
    f"= '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority) FROM orders)",
    "quarantine_good": f"SELECT {_STAGED} FROM orders WHERE o_orderpriority <> '5-LOW'",
    "quarantine_bad": """SELECT '  ' || o_orderkey || ' ' AS order_id, 'soon' AS order_day,
        CASE WHEN o_orderstatus = 'P' THEN 'NULL' ELSE
            ' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
        o_orderstatus || '  ' AS order_status, 'order_day: not a date' AS "REJECT_REASON"
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "quarantine_by_rule": """SELECT *,
        CASE WHEN event_type <> 'error' AND value > 0 THEN 'stg' ELSE 'quarantine' END AS zone
        FROM events""",
    "latest_version": """
        SELECT * EXCLUDE (rank) FROM (
            SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate),
                row_number() OVER (PARTITION BY l_orderkey ORDER BY
                    CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC,
                    l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                    l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rank
            FROM lineitem) WHERE rank = 1""",
    "upsert_by_key": """SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
        ELSE '9-NEW' END AS o_orderpriority) FROM orders""",
    "upsert_touched_partitions": """SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN '9-NEW'
        ELSE o_orderpriority END AS o_orderpriority) FROM orders""",
    "incremental_since": """SELECT * FROM events
        WHERE ts > TIMESTAMP '2024-01-20 12:00:00'""",
    "incremental_watermark": """SELECT CAST(max(event_id) AS VARCHAR) AS high_water_mark
        FROM events""",
    "incremental_ingest": "SELECT * FROM events",
    "incremental_by_partition": "SELECT * FROM events",
    "incremental_late_rows": """SELECT * REPLACE (CASE WHEN event_id % 10 <> 0
        THEN date_trunc('day', ts)::TIMESTAMP END AS ts) FROM events""",
    "slices_by_range": "\nUNION ALL\n".join(
        f"""SELECT CAST({i} AS INTEGER) AS slice, count(*) FILTER (WHERE {rule}) AS row_count
        FROM orders"""
        for i, rule in enumerate(
            (
                "o_orderkey < 1000",
                "o_orderkey BETWEEN 1000 AND 4999",
                "o_orderkey BETWEEN 5000 AND 9999",
                "o_orderkey >= 10000",
            )
        )
    ),
    "slices_even": """SELECT CAST(o_orderkey % 7 AS INTEGER) AS slice, count(*) AS row_count
        FROM orders GROUP BY 1""",
    "parquet_roundtrip": "SELECT * FROM orders",
    "save_modes": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "partitioned_overwrite": """SELECT * REPLACE (CASE WHEN o_orderpriority = '5-LOW'
        THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders""",
    "json_append": """SELECT count(*) AS row_count, '2024-01-30' AS run_date FROM orders
        UNION ALL SELECT count(*), '2024-01-31' FROM orders""",
    "csv_landing": "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'",
    "csv_landing_corrupt": """SELECT concat_ws(',', 'x' || c_custkey, c_name,
        c_nationkey::VARCHAR, c_acctbal::VARCHAR, 'BUILDING')
        AS _corrupt_record, c_name FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "schema_evolution": """SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F'
        THEN o_orderpriority END AS o_orderpriority) FROM orders""",
    "stacked_versions": """SELECT * REPLACE (
        CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority) FROM orders""",
    "ingest_report": """SELECT 'ingest' AS pipeline_name, 'raw' AS stage_name,
            'orders' AS table_name, 'SUCCESS' AS status, count(*) AS row_count FROM orders
        UNION ALL SELECT 'ingest', 'raw', 'customer', 'SUCCESS', count(*) FROM customer
        UNION ALL SELECT 'ingest', 'raw', 'absent', 'FAILED', NULL""",
    "ingest_by_date": f"""SELECT *, '20240130' AS "ETL_DATE" FROM orders
        UNION ALL SELECT *, '{RUN_DATE}' FROM orders""",
    "ingest_stamps": "SELECT count(*) AS row_count, count(*) AS stamped, 1::BIGINT AS stamps FROM orders",
    "audit_stamps": "SELECT 5::BIGINT AS checks, 5::BIGINT AS stamped, 1::BIGINT AS stamps",
    "map_text_dates": _links(
        "orders", VALID_ORDERS, "TBAADM.GAM", "AR_X_ACT_CLS_BAL", ("AR|TBAADM.GAM", "o_orderkey"),
        ("AU|TBAADM.GAM", "CAST(o_orderkey AS VARCHAR) || '.CLS_BAL'"),
        "CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(o_orderdate AS DATE) END",
    ),
    "mapping_from_file": _link_sql("13"),
    "checksum_xxhash_lanes": """SELECT l_returnflag, count(*) AS row_count, TRUE AS agrees
        FROM lineitem GROUP BY 1""",
    "totals_fine_scale": """
        WITH s AS (SELECT o_orderstatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(20,6))) AS v
            FROM orders GROUP BY 1)
        SELECT o_orderstatus, n AS source_rows, n AS target_rows, v AS source_o_totalprice,
            v + CASE WHEN o_orderstatus = 'P' THEN n * 0.0003::DECIMAL(7,6) ELSE 0 END
                AS target_o_totalprice,
            CASE WHEN o_orderstatus = 'P' THEN 'FAIL' ELSE 'PASS' END AS status FROM s""",
    "zone_chain_links": _link_sql(_ALL),
    "zone_chain_audit": _audit_sql(_link_sql(_ALL), extra=_AS_EXPECTED),
    "zone_chain_audit_rejecting": _audit_sql(
        _REJECTING, _GAPS, _AS_EXPECTED + """
UNION ALL SELECT 'Expected Checksum', 'FAIL',
    'Expected: rows:0|hash_sum:0, SOR: ' || hashed FROM target"""
    ),
    "zone_chain_copy": "SELECT DISTINCT * FROM lineitem",
    "zone_chain_clean": f"SELECT {_STAGED} FROM orders WHERE o_orderpriority <> '5-LOW'",
    "zone_chain_bills": f"""SELECT l_orderkey || '-' || l_linenumber AS "BILL_ID",
        CASE WHEN l_returnflag = 'N' THEN 'N' ELSE 'Y' END AS "DEL_FLG",
        CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS "ENTITY_CRE_FLG",
        '{RUN_DATE}' AS "ETL_DATE" FROM lineitem""",
}
ORACLES["zone_chain_quarantine"] = ORACLES["quarantine_bad"]
ORACLES["quarantine_two_runs"] = f"""
    SELECT *, '20240130' AS "RUN_DATE" FROM ({ORACLES["quarantine_bad"]}) WHERE order_status <> 'F  '
    UNION ALL SELECT *, '{RUN_DATE}' FROM ({ORACLES["quarantine_bad"]})"""
ORACLES["zone_chain_diff"] = ORACLES["row_diff"]
ORACLES["upsert_table_twice"] = ORACLES["upsert_by_key"]
