"""Readers, writers and generators for vector tables."""
