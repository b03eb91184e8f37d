"""Streaming: incremental ingest of new files into the keyed store (same operators as the batch)."""
