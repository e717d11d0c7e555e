"""Column-to-column helpers; no Python UDFs."""
