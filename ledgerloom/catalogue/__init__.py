"""Runnable examples of every operator on the given tables, with their SQL twins."""

from ledgerloom.catalogue import changes, contracts, kept, ranges, upkeep  # noqa: F401  they add their queries
from ledgerloom.catalogue.oracles import ORACLES
from ledgerloom.catalogue.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
