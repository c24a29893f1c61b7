"""Structured Streaming: sources, parsing shared with batch, stateful operators, sinks."""
