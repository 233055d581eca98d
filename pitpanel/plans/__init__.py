"""Composite jobs (what a user calls) and the query catalogue."""
