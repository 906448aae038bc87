"""Column-level predicates, parsers and validators."""
