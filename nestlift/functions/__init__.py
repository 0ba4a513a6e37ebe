"""Column-level helpers: declared type rules, JSON parse/infer, identifier quoting."""
