"""Registered queries with their SQL counterparts, by topic."""
