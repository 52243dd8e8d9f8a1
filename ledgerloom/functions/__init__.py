"""Column-level building blocks: labels, measures and text helpers."""
