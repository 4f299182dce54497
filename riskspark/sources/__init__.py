"""Readers and writers: transaction tables, model folders, scratch tables."""
