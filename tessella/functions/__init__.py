"""Sessions, shared folders and column functions."""
