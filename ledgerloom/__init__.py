"""Batch movement of relational tables through raw, staging, system-of-record and reconcile zones."""
