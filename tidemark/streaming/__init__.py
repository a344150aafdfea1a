"""Structured Streaming: tailing reads, delivery guarantees, event-time ordering, metrics."""
