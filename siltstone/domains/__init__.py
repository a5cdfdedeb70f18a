"""Domain definitions: what the generic operators need to know about one kind of data."""
