"""Readers, writers and the derived test fixture."""
