"""Structured Streaming form of the live path: sources, the keyed stateful processor and idempotent sinks."""
