"""Column expressions: header fields, text cleaning, tokens."""
