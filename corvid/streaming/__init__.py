"""Structured Streaming: sources, transformations, sinks and a bounded runner."""
