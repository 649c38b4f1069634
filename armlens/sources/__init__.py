"""Readers, landing and writers."""
