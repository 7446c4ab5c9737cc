"""Structured Streaming: message decoding, per-batch recommendations, query runners."""
