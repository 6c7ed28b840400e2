"""Readers, schema helpers and writers."""
