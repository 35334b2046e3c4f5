"""Scans, key-range tiles and row batches."""
