"""Readers, writers and the logical tables."""
