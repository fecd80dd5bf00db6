"""The registered queries: library operators over the given tables, with SQL twins."""
