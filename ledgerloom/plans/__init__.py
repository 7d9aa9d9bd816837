"""Declared mappings, contracts and the jobs that run them zone to zone."""
