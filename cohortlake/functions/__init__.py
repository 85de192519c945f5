"""Column expressions and small helpers the operators share."""
