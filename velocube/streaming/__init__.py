"""Structured Streaming jobs (file source -> stateful operators -> sinks)."""
