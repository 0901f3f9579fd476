"""Relational operators the plans are made of."""
