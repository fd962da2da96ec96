"""Column expressions (no DataFrame in sight): parsing, time, text."""
