"""Column expressions: naming, parsing, keys, bands, calendar parts, hashes."""
