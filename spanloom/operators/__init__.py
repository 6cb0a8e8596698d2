"""Operators over spans, metrics, registries and texts."""
