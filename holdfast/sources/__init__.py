"""Readers, writers, and the declarative data contract."""
