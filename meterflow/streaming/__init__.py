"""Structured Streaming jobs: topic ingest and stateful change detection."""
