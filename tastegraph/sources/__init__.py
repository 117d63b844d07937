"""Scans (CSV / Parquet with fixed schemas), fixture relations and sinks."""
