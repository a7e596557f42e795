"""Whole lookups made of several operators."""
