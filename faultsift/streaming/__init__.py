"""Incremental triage with Structured Streaming."""
