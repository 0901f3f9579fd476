"""Contracts, readers, writers and the state of source drops."""
