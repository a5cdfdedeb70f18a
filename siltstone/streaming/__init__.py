"""Incremental variants of the batch layers."""
