"""Column expressions: rendering, digests, blank tests, tokens."""
