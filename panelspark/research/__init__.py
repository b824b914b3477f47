"""Composite market indices, event studies and sector rotation."""
