"""Column expressions: canonical text, digests, tolerances, scalars and type rules."""
