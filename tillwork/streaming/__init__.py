"""Structured Streaming forms of the import and the price history."""
