"""Structured Streaming forms of the time buckets (beyond the dialect itself)."""
