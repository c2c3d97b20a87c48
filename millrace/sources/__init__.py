"""Readers and writers: landing files, layer tables, catalog tables."""
