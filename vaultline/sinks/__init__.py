"""Sinks: versioned Parquet tables, append-only raw tables, ledgers, CSV export."""
