"""Structured Streaming: ingest, and state machines per host."""
