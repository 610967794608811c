"""Column expressions: pointers, payload fields, fingerprints, issue text."""
