"""Readers and content caches."""
