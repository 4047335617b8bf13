"""Column expressions: similarity measures and text helpers."""
