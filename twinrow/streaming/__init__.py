"""The comparisons as running streams."""
