"""Readers, writers and views over the input tables."""
