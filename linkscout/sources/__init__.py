"""Readers, writers and the derived test views."""
