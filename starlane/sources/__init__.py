"""Readers for CSV and JSON drops, path routing and the processed-file ledger."""
