"""Reusable DataFrame operators: lookups, expansion, merging and counters."""
