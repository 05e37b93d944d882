"""Structured Streaming jobs: run-once append, per-batch merge."""
