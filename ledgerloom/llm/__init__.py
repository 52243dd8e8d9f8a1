"""Operators for preparing training text: cleaning, scoring, mixing and token files."""
