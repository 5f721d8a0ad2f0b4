"""Column expressions: text cleaning, value grammar, WKB headers, projections."""
