"""Column expressions: record parsing and scalar functions."""
