"""Readers and writers for tables and for genomics text formats."""
