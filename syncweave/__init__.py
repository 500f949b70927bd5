"""Incremental synchronisation and reconciliation of a wide fact table, declared as Spark plans."""
