"""Structured Streaming operators; all of them also run on batch frames."""
