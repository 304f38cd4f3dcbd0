"""Filters on streams of documents."""
