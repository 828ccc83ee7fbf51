"""Incremental bronze -> silver loading with Structured Streaming."""
