"""Readers and catalog tables."""
