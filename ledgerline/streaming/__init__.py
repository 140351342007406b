"""Streaming: incremental loads as Structured Streaming micro-batches."""
