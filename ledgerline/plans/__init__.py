"""Composite plans: control table, full and incremental loads, query catalog."""
