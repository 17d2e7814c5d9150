"""Sessions from a growing log, with Structured Streaming."""
