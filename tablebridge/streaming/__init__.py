"""Incremental scans and micro-batched copies."""
