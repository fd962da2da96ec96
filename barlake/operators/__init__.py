"""DataFrame-to-DataFrame operators. None of them puts a whole series, key or file in one task."""
