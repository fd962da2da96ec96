"""Readers: ticker universe, landing files, the stored lake, and pluggable fetchers."""
