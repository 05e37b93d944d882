"""Sinks: Bronze landing (daily folders, JSON lines)."""
