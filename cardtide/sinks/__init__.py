"""Outputs: report lines as text and typed tables as Parquet."""
