"""Readers of landed files and tables, and the writers of each layer."""
