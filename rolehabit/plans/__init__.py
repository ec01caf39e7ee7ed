"""Whole jobs: one tick, a replay over history, ingest."""
