"""Readers, writers and the logical tables that queries work on."""
