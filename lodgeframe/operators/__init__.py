"""Table operators: each takes a DataFrame first and returns a DataFrame."""
