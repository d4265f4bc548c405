"""Incremental snapshot loads with Structured Streaming."""
