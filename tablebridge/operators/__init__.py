"""Distributed checks, rewrites and comparisons."""
