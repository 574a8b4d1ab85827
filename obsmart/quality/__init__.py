"""Gate, data tests, output contracts and run records."""
