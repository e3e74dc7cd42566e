"""Spark operators that turn landed web data into clean, deduplicated entity tables."""
