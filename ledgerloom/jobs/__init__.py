"""Command line jobs that read feeds and write the report tables."""
