"""Readers, writers and the mappings of the sites events come from."""
