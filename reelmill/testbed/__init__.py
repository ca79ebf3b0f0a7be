"""Inputs, queries and SQL checks on the benchmark tables."""
