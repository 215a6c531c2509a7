"""Readers and writers: landing files, seeds, raw and derived tables."""
