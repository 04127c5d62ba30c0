"""Event envelopes, stream sources, monitors and runners (Structured Streaming)."""
