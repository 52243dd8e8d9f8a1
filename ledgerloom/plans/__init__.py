"""Report plans: each takes DataFrames and returns one report DataFrame."""
