"""Whole jobs composed of the operators: clean, merge, check, publish, and the full run."""
