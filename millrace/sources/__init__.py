"""Readers, writers and table directories."""
