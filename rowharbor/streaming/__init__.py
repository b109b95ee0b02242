"""File-driven incremental loads with Structured Streaming."""
