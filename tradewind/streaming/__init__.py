"""Streaming sinks, stateful operators and job runners."""
