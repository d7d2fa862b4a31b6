"""Column expressions: cleaning, unit conversion, grading."""
