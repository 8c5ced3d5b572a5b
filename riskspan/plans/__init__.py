"""Composite jobs (what a user runs) and the driver query registry."""
