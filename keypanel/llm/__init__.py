"""Operators for large text corpora; each module is one operator."""
