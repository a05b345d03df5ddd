"""Relational operators: deduplication, merge, delete, quality rules and profiling."""
