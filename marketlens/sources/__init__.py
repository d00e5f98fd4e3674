"""Readers for landed responses and stage files, writers, and request lists."""
