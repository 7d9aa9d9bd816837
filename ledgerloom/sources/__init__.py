"""Zone addressing, table readers and table writers."""
