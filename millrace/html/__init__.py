"""Tolerant HTML trees, main content, metadata and their Markdown or simple-HTML forms."""
