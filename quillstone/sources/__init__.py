"""Readers of tables, versioned documents and files."""
