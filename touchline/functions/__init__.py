"""Column expressions: codes, formulas and text helpers."""
