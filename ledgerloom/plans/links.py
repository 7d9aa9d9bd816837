"""The arrangement-to-accounting-unit relationship table as data."""

from __future__ import annotations

from dataclasses import replace

from ledgerloom.operators.checks import AuditSpec
from ledgerloom.operators.mapping import LINK_SCHEMA, Block, KeyRule, LinkSource, LinkSpec

# Table names, system names, key prefixes, relationship types,
# flags, scheme types and dates below decide the hashes and the rows.
ACCOUNT_TABLE = "TBAADM_GAM_TDY"
BILL_TABLE = "TBAADM_FBM_TDY"
LINK_TABLE = "AR_X_AU"

ACCOUNTS = LinkSource(
    table=ACCOUNT_TABLE,
    system="TBAADM.GAM",
    arrangement=KeyRule("AR|TBAADM.GAM", ("ACID",)),
    valid="ENTITY_CRE_FLG = 'Y' AND DEL_FLG = 'N'",
    optional_equals=(("BANK_ID", "01"),),
    effective_from="ACCT_OPN_DATE",
    blocks=(
        Block(
            "1",
            "AR_X_GLSH",
            KeyRule("AU|TBAADM.GSH", ("GL_SUB_HEAD_CODE", "SOL_ID", "ACCT_CRNCY_CODE")),
        ),
        Block("2", "AR_X_ACT_CLS_BAL", KeyRule("AU|TBAADM.GAM", ("ACID",), suffix=".CLS_BAL")),
        Block(
            "3",
            "AR_X_ACT_USED_PRVN_AMT",
            KeyRule("AU|TBAADM.GAM", ("ACID",), suffix=".USED_PRVN_AMT"),
            where="SCHM_TYPE IN ('CLA', 'LAA', 'ODA')",
        ),
        Block("7", "AR_X_ACT_BAL", KeyRule("AU|TBAADM.GAM", ("ACID",), suffix=".BAL")),
    ),
)

BILLS = LinkSource(
    table=BILL_TABLE,
    system="TBAADM.FBM",
    arrangement=KeyRule("AR|TBAADM.FBM", ("BILL_ID",)),
    valid="ENTITY_CRE_FLG = 'Y' AND DEL_FLG = 'N'",
    blocks=(Block("8", "AR_X_ACT_BAL", KeyRule("AU|TBAADM.FBM", ("BILL_ID",), suffix=".BAL")),),
)

LINKS = LinkSpec(
    name=LINK_TABLE,
    sources=(ACCOUNTS, BILLS),
    system_prefix="CL|SRC_STM",
    relationship_prefix="CL|AR_X_AU_TP",
    opening_run_types=("FIRST", "FULL"),
    run_types=("FIRST", "FULL", "DELTA"),
    end_date="9999-12-31",
)

# The audit of the relationship table; labels are fixed values. Its source count
# looks at the flags only, not at the bank.
LINK_AUDIT = AuditSpec(
    keys=("AR_ID", "AU_ID"),
    checksum_columns=("AR_ID", "AU_ID", "AR_X_AU_RLTNP_TP_ID"),
    contract=LINK_SCHEMA,
    source_valid=ACCOUNTS.valid,
    source_label="Raw GAM Valid Rows",
    target_label="SOR",
)


def with_key_prefixes(audit: AuditSpec, spec: LinkSpec) -> AuditSpec:
    """The audit with the Collapsed Key check for the prefixes of a mapping."""
    arrangements = {s.arrangement.prefix for s in spec.sources}
    units = {b.unit.prefix for s in spec.sources for b in s.blocks}
    return replace(
        audit,
        key_prefixes={"AR_ID": tuple(sorted(arrangements)), "AU_ID": tuple(sorted(units))},
    )
