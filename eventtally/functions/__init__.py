"""Column expressions and join helpers shared by the batch and streaming code."""
