"""Operators that prepare text corpora; nothing outside this package imports it."""
