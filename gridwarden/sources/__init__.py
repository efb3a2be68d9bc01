"""Readers, writers and the adapters from the provided test tables."""
