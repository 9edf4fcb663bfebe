"""Readers, period helpers and writers."""
