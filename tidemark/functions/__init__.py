"""Column expressions and whole-table cumulative sums shared by the operators."""
