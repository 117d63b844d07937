"""Structured Streaming: the stateful feedback fold and re-scoring of touched users."""
