"""Operators over record tables."""
