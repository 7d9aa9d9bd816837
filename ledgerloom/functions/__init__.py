"""Column expressions for surrogate keys, row hashes and table checksums."""

from ledgerloom.functions.keys import (
    composite_value,
    portable_fingerprint,
    row_hash,
    surrogate_key,
    with_row_hash,
    xxhash_fingerprint,
)
from ledgerloom.functions.checksums import (
    checksum_text,
    hash_sum_lanes,
    merge_lanes,
    table_checksum,
)

__all__ = [
    "checksum_text",
    "composite_value",
    "hash_sum_lanes",
    "merge_lanes",
    "portable_fingerprint",
    "row_hash",
    "surrogate_key",
    "table_checksum",
    "with_row_hash",
    "xxhash_fingerprint",
]
