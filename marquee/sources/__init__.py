"""Readers, writers and keyed table changes."""
