"""Structured Streaming: spans in, derived metrics and their states out."""
