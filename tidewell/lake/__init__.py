"""Keyed lake tables: bucketed Parquet base plus an append-only change log."""
