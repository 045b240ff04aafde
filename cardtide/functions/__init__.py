"""Column expressions: cleaning, parsing, labels and text renderings."""
