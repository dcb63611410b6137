"""Stateless operators over Structured Streaming."""
