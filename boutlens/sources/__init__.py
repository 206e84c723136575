"""Readers, writers and the snapshot pointer."""
